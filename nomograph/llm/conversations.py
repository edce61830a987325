"""Repair of conversations: the cheapest edits after which roles alternate, by a bidirectional DAG of tight arcs.

A conversation's rows and the states of the automaton of legal role initials, (s?(ua)+)?, span a graph: Keep, Rerole
and Delete lead past a row, Insert stays before it. Least costs from the start and least costs to the end are computed
for every node; an arc is tight if the cost before it, its own and the cost behind it add up to the whole's least cost.
The tight arcs are exactly the optimal ones, and a traversal of the set of nodes reached so far that takes the least
letter at each step reads off the least of all cheapest edit strings.

Costs along a stretch of rows are a 4 x 4 matrix over (min, +), so no conversation has to lie in one task: rows
without their texts are sorted by range, each partition reduces its first and its last stretch to a matrix, and the
costs that enter and leave each partition follow from these (two a partition, on the driver). Tight arcs are then found
in each partition alone. The last pass streams each conversation's rows in order, with the texts, walks the tight arcs
and hashes the repaired text: its memory doesn't grow with the number of rows, but for the result's own string.

Rows are in the order of turn (nulls first), then of the SHA-256 of role and text, as turns name rows only once in a
well-formed table. Defined cases: null conv_id, turn, role and text are read as one space (a null conv_id is a
conversation); a role's initial is its first character, and an empty role has none; repeated rows stand next to each
other; a conversation that loses all rows has zeros and empty strings; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import SPACE, checkpoint_dir, cut, no_table, pick, small_batches, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3
LEGAL = ("su", "ua", "au")

INF = float("inf")
#: States of (s?(ua)+)?: nothing yet, after s, after u, after a; and where a user or an assistant leads.
STATES = range(4)
_USER, _ASSISTANT = (2, 2, None, 2), (None, None, 3, None)
_TURN = tuple(u if u is not None else a for u, a in zip(_USER, _ASSISTANT, strict=True))  # the one role that is legal, by state
_ENDS = (0, 3)
#: Letters in ASCII order; a row's arcs take a bit each: state * 4 + letter.
LETTERS = "DIKR"


def _kept(initial: str) -> tuple[int | None, ...]:
    """Where keeping a row of this initial leads, by state."""
    return {"s": (1, None, None, None), "u": _USER, "a": _ASSISTANT}.get(initial, (None,) * 4)


def _inserted(f: list[float]) -> list[float]:
    """Least costs at a layer after any number of inserts there."""
    u = min(f[2], f[0] + INSERT, f[1] + INSERT, f[3] + INSERT)
    return [f[0], f[1], u, min(f[3], u + INSERT)]


def _inserted_back(b: list[float]) -> list[float]:
    a = min(b[3], b[2] + INSERT)
    u = min(b[2], a + INSERT)
    return [min(b[0], u + INSERT), min(b[1], u + INSERT), u, min(a, u + INSERT)]


def _arcs(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    """The arcs past a row: (letter, state, next state, cost)."""
    found = [(0, q, q, DELETE) for q in STATES]
    if fault not in (BLANK, DUPLICATE):
        more, kept = TRUNCATED if fault == CUT_OFF else 0, _kept(initial)
        found += [(2, q, kept[q], KEEP + more) for q in STATES if kept[q] is not None]
        found += [(3, q, _TURN[q], REROLE + more) for q in STATES]
    return found


_KNOWN: dict[tuple[str, int], list[tuple[int, int, int, int]]] = {}


def _row(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    key = (initial if initial in ("s", "u", "a") else "", fault)
    if key not in _KNOWN:
        _KNOWN[key] = _arcs(*key)
    return _KNOWN[key]


START = (0.0, INF, INF, INF)
END = tuple(0.0 if q in _ENDS else INF for q in STATES)


def forward(rows: list[tuple[str, int]], enter: tuple[float, ...] | list[float]) -> list[list[float]]:
    """Least costs from the start to each node, by layer; enter holds those at the first layer, before its inserts."""
    out = [_inserted(list(enter))]
    for initial, fault in rows:
        f, g = out[-1], [INF] * 4
        for _, q, to, c in _row(initial, fault):
            if f[q] + c < g[to]:
                g[to] = f[q] + c
        out.append(_inserted(g))
    return out


def backward(rows: list[tuple[str, int]], leave: tuple[float, ...] | list[float]) -> list[list[float]]:
    """Least costs from each node to the end, by layer; leave holds those at the last layer, behind its inserts."""
    out = [_inserted_back(list(leave))]
    for initial, fault in reversed(rows):
        b, g = out[-1], [INF] * 4
        for _, q, to, c in _row(initial, fault):
            if b[to] + c < g[q]:
                g[q] = b[to] + c
        out.append(_inserted_back(g))
    return out[::-1]


def tight(rows: list[tuple[str, int]], enter, leave) -> tuple[list[int], int]:
    """The optimal arcs of each row, and inserts behind the last, as bits; enter and leave as for forward and backward."""
    f, b = forward(rows, enter), backward(rows, leave)
    best = min(x + y for x, y in zip(f[0], b[0], strict=True))

    def inserts(i: int) -> int:
        return sum(1 << (q * 4 + 1) for q in STATES if f[i][q] + INSERT + b[i][_TURN[q]] == best)

    masks = []
    for i, (initial, fault) in enumerate(rows):
        mask = inserts(i)
        for letter, q, to, c in _row(initial, fault):
            if f[i][q] + c + b[i + 1][to] == best:
                mask |= 1 << (q * 4 + letter)
        masks.append(mask)
    return masks, inserts(len(rows))


def matrix(rows: list[tuple[str, int]]) -> list[list[float]]:
    """Least costs through a stretch of rows from each state to each. Inserts at either end may be counted by both neighbours: inserting more often than once gains nothing."""
    return [forward(rows, [0.0 if q == p else INF for q in STATES])[-1] for p in STATES]


def _through(f, m) -> list[float]:
    return [min(f[p] + m[p][q] for p in STATES) for q in STATES]


def _through_back(m, b) -> list[float]:
    return [min(m[p][q] + b[q] for q in STATES) for p in STATES]


class Walk:
    """The traversal of a conversation's tight arcs: step() for each row, then end()."""

    def __init__(self) -> None:
        self.at = frozenset((0,))

    def _least(self, mask: int) -> int | None:
        return next((k for k in range(4) if any(mask >> (q * 4 + k) & 1 for q in self.at)), None)

    def _insert(self, mask: int) -> str:
        """Takes inserts; returns the role that they give."""
        self.at = frozenset(_TURN[q] for q in self.at if mask >> (q * 4 + 1) & 1)
        return self._role()

    def _role(self) -> str:
        return "user" if 2 in self.at else "assistant"

    def step(self, mask: int, initial: str) -> Iterator[tuple[str, str | None]]:
        """The letters up to and with the row's own, each with the new role of what it leaves (None: the row's own role; for a deleted row nothing is left)."""
        while (k := self._least(mask)) == 1:
            yield "I", self._insert(mask)
        on = [q for q in self.at if mask >> (q * 4 + k) & 1]
        if k == 0:
            self.at = frozenset(on)
        else:
            to = _kept(initial) if k == 2 else _TURN
            self.at = frozenset(to[q] for q in on)
        yield LETTERS[k], self._role() if k == 3 else None

    def end(self, mask: int) -> Iterator[tuple[str, str]]:
        """Inserts behind the last row, until an end is reached."""
        while not self.at & set(_ENDS):
            yield "I", self._insert(mask)


# --- damage ---


def _word(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times (0: dropped, 2: repeated) of every row, faults put in by the hash of its key."""
    role, said = _word(F.col("role")), _word(F.col("text"))
    fault = F.crc32(F.concat(_word(F.col("conv_id")), F.lit(":"), _word(F.col("turn"))).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(said, ".!?", "")).otherwise(said)
    return pick(rows, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times")
    )


# --- the light rows: faults, order, costs ---


def _faults(damaged: DataFrame) -> DataFrame:
    """conv_id, turn, digest, initial, fault, times: one row for all equal ones. A digest is seen earlier if it has a row of an earlier turn; of equal rows all but the first are duplicates."""
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    own = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), CUT_OFF).otherwise(0)
    light = damaged.where("times > 0").select("conv_id", "turn", _digest(), F.left("role", F.lit(1)).alias("initial"), own.alias("own"), "times")
    light = light.groupBy("conv_id", "turn", "digest", "initial", "own").agg(F.sum("times").alias("times"))
    place = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy("turn"))
    return light.withColumn("fault", F.when(F.col("own") == BLANK, BLANK).when(place > 1, DUPLICATE).otherwise(F.col("own"))).drop("own")


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("digest")


def _unfold(fault: int, times: int) -> list[int]:
    """The faults of equal rows."""
    return [fault] + [fault if fault == BLANK else DUPLICATE] * (times - 1)


class Stretches:
    """The conversations of a partition's sorted rows, one after another: (conv_id, its rows' numbers in the batches)."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self):
        conv, rows, any_yet = None, [], False
        for batch in batches_of(self.batches, "conv_id", "turn", "digest", "initial", "fault", "times"):
            for c, *row in batch:
                if any_yet and c != conv:
                    yield conv, rows
                    rows = []
                conv, any_yet = c, True
                rows.append(row)
        if any_yet:
            yield conv, rows


def batches_of(batches: Iterator[pa.RecordBatch], *names: str):
    for batch in batches:
        yield zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names], strict=True)


def _flat(rows: list) -> list[tuple[str, int]]:
    return [(r[2], fault) for r in rows for fault in _unfold(r[3], r[4])]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a partition, each with its stretch's matrix and its last initial."""
    no_table()
    first = last = None
    for conv, rows in Stretches(batches):
        last = (conv, rows)
        first = first or last
    if first is None:
        return
    both = [first] if first is last else [first, last]
    costs = [[x for line in matrix(_flat(rows)) for x in line] for _, rows in both]
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()] * len(both), pa.int32()), pa.array([c for c, _ in both], pa.int64()), pa.array(costs, pa.list_(pa.float64())), pa.array([rows[-1][2] for _, rows in both])],
        ["part", "conv", "costs", "initial"],
    )


def _borders(ends: list) -> dict[int, tuple]:
    """For each partition: costs that enter its first conversation, the initial before it, whether it goes on from before; costs that leave its last, and whether that goes on."""
    parts: dict[int, list] = {}
    for e in sorted(ends, key=lambda e: e["part"]):  # a partition's rows come in their order
        parts.setdefault(e["part"], []).append((e["conv"], [e["costs"][p * 4 : p * 4 + 4] for p in STATES], e["initial"]))
    order, enter, leave = list(parts), {}, {}
    f, before = list(START), None
    for n, k in enumerate(order):
        goes_on = n > 0 and parts[order[n - 1]][-1][0] == parts[k][0][0]
        if not goes_on:
            f, before = list(START), None
        enter[k] = (f, before, goes_on)
        if len(parts[k]) > 1:
            f = list(START)
        f, before = _through(f, parts[k][-1][1]), parts[k][-1][2]
    b = list(END)
    for n, k in reversed(list(enumerate(order))):
        goes_on = n + 1 < len(order) and parts[order[n + 1]][0][0] == parts[k][-1][0]
        if not goes_on:
            b = list(END)
        leave[k] = (b, goes_on)
        if len(parts[k]) > 1:
            b = list(END)
        b = _through_back(parts[k][0][1], b)
    return {k: (*enter[k], *leave[k]) for k in order}


_SOLVED = "conv_id long, turn long, digest string, masks binary, behind int, initial string, fault int, illegal long, seq long"


def _solve(batches: Iterator[pa.RecordBatch], borders: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """Every row's tight arcs (three bytes for each of its copies), and its count of illegal neighbours."""
    no_table()
    part = TaskContext.get().partitionId()
    if part not in borders:
        return
    f, before, goes_on, b, goes_further = borders[part]
    seq, out = 0, []

    def solved(conv, rows, enter, leave, initial, last: bool):
        nonlocal seq
        masks, behind = tight(_flat(rows), enter, leave)
        at = 0
        for n, (turn, digest, own, fault, times) in enumerate(rows):
            bad = (initial is not None and initial + own not in LEGAL) + (times - 1) * (own + own not in LEGAL)
            mask = b"".join(m.to_bytes(3, "little") for m in masks[at : at + times])
            at += times
            out.append((conv, turn, digest, mask, behind if last and n == len(rows) - 1 else None, own, fault, bad, part << 40 | seq))
            initial, seq = own, seq + 1

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()], strict=True)], [n.split()[0] for n in _SOLVED.split(", ")])
        out.clear()
        return batch

    held, first = None, True
    for conv, rows in Stretches(batches):
        if held is not None:
            solved(*held, list(END), held_before, True)
            if len(out) >= 1000:
                yield flushed()
        held, held_before = (conv, rows, f if first and goes_on else list(START)), before if first and goes_on else None
        first = False
    if held is not None:
        solved(*held, b if goes_further else list(END), held_before, not goes_further)
    if out:
        yield flushed()


# --- the last pass ---

_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Repaired:
    """One conversation while its rows stream past."""

    def __init__(self, conv: int | None):
        self.conv, self.walk, self.hash, self.lines = conv, Walk(), hashlib.sha256(), 0
        self.least = self.most = None
        self.turns = self.illegal = self.cost = 0
        self.faults, self.audit = [0] * 4, bytearray()

    def turn(self, turn: int | None) -> None:
        """Turns come in order."""
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1

    def _say(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def row(self, mask: int, initial: str, fault: int, role: str, text: str) -> None:
        self.faults[fault] += 1
        for letter, new in self.walk.step(mask, initial):
            self.audit += letter.encode()
            if letter == "I":
                self.cost += INSERT
                self._say(new, "")
            elif letter == "D":
                self.cost += DELETE
            else:
                self.cost += (KEEP if letter == "K" else REROLE) + TRUNCATED * (fault == CUT_OFF)
                self._say(new or role, text)

    def done(self, behind: int) -> tuple:
        for letter, new in self.walk.end(behind):
            self.audit += letter.encode()
            self.cost += INSERT
            self._say(new, "")
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_OFF], self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solved rows and then the text of each (conversation, turn, digest), in order."""
    no_table()
    now, behind, key, held, out = None, 0, None, [], []

    def flushed() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [n.split()[0] for n in _RESULT.split(", ")])
        out.clear()
        return batch

    for batch in batches_of(batches, "conv_id", "turn", "digest", "kind", "masks", "behind", "initial", "fault", "illegal", "role", "text"):
        for conv, turn, digest, kind, masks, end, initial, fault, illegal, role, text in batch:
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.done(behind))
                    if len(out) >= 1000:
                        yield flushed()
                now, behind, key = Repaired(conv), 0, None
            if kind == 0:
                held.append((masks, initial, fault))
                now.turn(turn)
                now.illegal += illegal
                behind = end if end is not None else behind
            elif kind == 1 and held:  # the first text of an equal run; the others are the same
                for masks, initial, fault in held:
                    n = len(masks) // 3
                    for k, own in enumerate(_unfold(fault, n)):
                        now.row(int.from_bytes(masks[3 * k : 3 * k + 3], "little"), initial, own, role, text)
                held = []
    if now is not None:
        out.append(now.done(behind))
    if out:
        yield flushed()


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after damage().

    Rows without texts are shuffled three times (equal rows, duplicates, order), texts once."""
    spark = conversations.sparkSession
    small_batches(spark)
    checkpoint_dir(spark)
    damaged = damage(conversations)
    order = ["conv_id", "turn", "digest"]
    light = cut(_faults(damaged).repartitionByRange(*order).sortWithinPartitions(*order))
    ends = light.mapInArrow(_ends, "part int, conv long, costs array<double>, initial string").collect()  # two rows a partition at most
    borders = spark.sparkContext.broadcast(_borders(ends))
    solved = light.mapInArrow(lambda batches: _solve(batches, borders.value), _SOLVED)
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    columns = ["conv_id", "turn", "digest", "kind", "seq", "masks", "behind", "initial", "fault", "illegal", "role", "text"]
    solved = solved.select("*", F.lit(0).alias("kind"), *none("string", "role", "text")).select(columns)
    texts = damaged.select("conv_id", "turn", F.when(F.col("times") > 0, _digest()).alias("digest"), F.when(F.col("times") > 0, 1).otherwise(2).alias("kind"), F.when(F.col("times") > 0, F.col("role")).alias("role"), F.when(F.col("times") > 0, F.col("text")).alias("text"))
    texts = texts.select("*", *none("long", "seq", "illegal"), *none("binary", "masks"), *none("int", "behind", "fault"), *none("string", "initial")).select(columns)
    both = solved.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest", "kind", "seq")
    return both.mapInArrow(_stream, _RESULT)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))
