"""Compression of vectors to codes of PARTS bytes: Lloyd's algorithm for each part, with heaps that say whom to rescan.

Components become integers, floor(SCALE * x). Each quarter of a vector has a codebook of at most ENTRIES entries,
which starts as that quarter of the vectors with the least ids; ROUNDS times every part goes to its nearest entry and
entries move to the floors of their parts' means; then all parts are assigned once more.

Vectors lie in blocks that never move between tasks. A block keeps, for every entry of every codebook, a heap of the
parts assigned to it, keyed by slack: the lower bound of the distance to any other entry minus the upper bound of the
distance to its own. An entry's movement raises upper bounds, the greatest movement of any other lowers lower bounds;
their sum is added up in one number for each entry (its drift), which is part of the key when a part is pushed. So
only parts whose key the drift has reached may have another nearest entry: these are popped, measured exactly against
all entries, and pushed again. All others stay unread. An ascending run is a heap in array form: that is how a heap is
stored, popped from its front and merged. Distances are integers, and equal ones never leave a slack above zero, so ties
always go to the lower index. Each round's blocks are written to the shared folder (the round before is then removed);
tasks return, summed, by how much each entry's sum and count have changed: ENTRIES x PARTS rows whatever the table.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, as are those whose
length differs from that of the kept vector of the least id; a length that isn't a multiple of PARTS is filled with
zeros at the end; rows without a vec_id come last in the order of ids, equal ids in the order of their vectors; repeated
rows are rows of their own; a table of fewer than ENTRIES vectors has as many entries as vectors; an empty table gives an
empty result; integers beyond a bound (2**28 for parts of 16 components), whose squared distances a long can't hold,
count as the bound; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm.common import cut, exists, folder_in, no_table, pick, remove, small_batches, table

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors of a block, and bytes of a group of blocks in a file.
BLOCK, GROUP_BYTES = 2048, 16 << 20
#: Labels up to this number are sent to all tasks; more are joined by a shuffle.
FEW_LABELS = 50_000


def _bound(width: int) -> int:
    """The greatest component whose squared distances over width components fit a long in all parts."""
    return int((2.0**60 / max(1, width)) ** 0.5) // 2


def integers(x: np.ndarray) -> np.ndarray:
    """Rows of floats as rows of PARTS parts of integers: (rows, PARTS, width)."""
    width = -(-x.shape[1] // PARTS)
    most = _bound(width)
    q = np.clip(np.floor(SCALE * x.astype(np.float64)), -most, most).astype(np.int64)
    return np.pad(q, ((0, 0), (0, width * PARTS - x.shape[1]))).reshape(len(x), PARTS, width)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each point its nearest entry (the first of equals), that squared distance, and the next entry's. Exact."""
    n, width = points.shape
    top = max(int(abs(points).max(initial=0)), int(abs(book).max(initial=0)))
    entry, least, second = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.float64)
    floats = 4 * width * top * top < 2**53  # every sum is an integer that a double holds
    e = book.astype(np.float64) if floats else book
    step = 2048 if floats else 64
    for at in range(0, n, step):
        p = points[at : at + step]
        if floats:
            f = p.astype(np.float64)
            d = np.einsum("ij,ij->i", f, f)[:, None] + np.einsum("ij,ij->i", e, e)[None, :] - 2 * (f @ e.T)
        else:
            d = ((p[:, None, :] - e[None, :, :]) ** 2).sum(axis=2)
        k = d.argmin(axis=1)
        rows = np.arange(len(p))
        entry[at : at + step], least[at : at + step] = k, d[rows, k].astype(np.int64)
        d = d.astype(np.float64)
        d[rows, k] = np.inf
        second[at : at + step] = d.min(axis=1)
    return entry, least, second


class Heaps:
    """The heaps of one part of a block: run j, from start[j] to start[j + 1], holds entry j's items by rising key."""

    def __init__(self, key: np.ndarray, item: np.ndarray, start: np.ndarray):
        self.key, self.item, self.start = key, item, start

    @classmethod
    def of(cls, entry: np.ndarray, key: np.ndarray, item: np.ndarray, entries: int) -> Heaps:
        order = np.lexsort((key, entry))
        return cls(key[order], item[order], np.searchsorted(entry[order], np.arange(entries + 1)))

    def entry(self) -> np.ndarray:
        """The entry of each slot."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def pop(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes out all items whose key the drift of their entry has reached; returns them, their entries, and the slots that stay."""
        stay = np.ones(len(self.key), bool)
        full = np.flatnonzero(np.diff(self.start) > 0)
        for j in full[self.key[self.start[full]] <= drift[full]]:  # only where a front is violated
            run = self.key[self.start[j] : self.start[j + 1]]
            stay[self.start[j] : self.start[j] + np.searchsorted(run, drift[j], "right")] = False
        return self.item[~stay], self.entry()[~stay], stay

    def push(self, stay: np.ndarray, item: np.ndarray, entry: np.ndarray, key: np.ndarray) -> Heaps:
        old = self.entry()[stay]
        return Heaps.of(np.concatenate([old, entry]), np.concatenate([self.key[stay], key]), np.concatenate([self.item[stay], item]), len(self.start) - 1)


def _slack(least: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Lower bound minus upper bound, less a margin for the rounding of roots and sums."""
    a, b = np.sqrt(least.astype(np.float64)), np.sqrt(second)
    return b - a - 1e-9 * (1 + a + np.where(np.isfinite(b), b, 0))


def _changes(points: np.ndarray, old: np.ndarray | None, new: np.ndarray, entries: int) -> np.ndarray:
    """How points that move from old to new entries change the entries' sums and, in the last column, counts."""
    out = np.zeros((entries, points.shape[1] + 1), np.int64)
    if old is not None:
        moved = old != new
        points, old, new = points[moved], old[moved], new[moved]
    rows = np.concatenate([points, np.ones((len(points), 1), np.int64)], axis=1)
    np.add.at(out, new, rows)
    if old is not None:
        np.subtract.at(out, old, rows)
    return out


def assign(points: np.ndarray, book: np.ndarray, drift: np.ndarray, heaps: Heaps | None) -> tuple[Heaps, np.ndarray, int]:
    """One round over one part of a block: its heaps, the changes of sums, and how many points were measured."""
    entries = len(book)
    if heaps is None:
        entry, least, second = nearest(points, book)
        return Heaps.of(entry, _slack(least, second) + drift[entry], np.arange(len(points), dtype=np.int32), entries), _changes(points, None, entry, entries), len(points)
    item, old, stay = heaps.pop(drift)
    if not len(item):
        return heaps, np.zeros((entries, points.shape[1] + 1), np.int64), 0
    entry, least, second = nearest(points[item], book)
    return heaps.push(stay, item, entry, _slack(least, second) + drift[entry]), _changes(points[item], old, entry, entries), len(item)


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What a step from old to new entries adds to each entry's drift: its own movement and the greatest of any other."""
    far = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    if len(far) == 1:
        return far
    top = np.argsort(far)[-2:]
    others = np.full(len(far), far[top[1]])
    others[top[1]] = far[top[0]]
    return (far + others) * (1 + 1e-12)


# --- blocks as rows ---

_STATE = "ids array<long>, labels array<string>, data binary, keys binary, items binary, starts binary, changes binary, measured long"


def _good(embedding: Column) -> Column:
    return F.coalesce((F.size(embedding) > 0) & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def _packed(q: np.ndarray) -> bytes:
    """A block's integers, two bytes each where they fit; the number of bytes tells the kind."""
    small = abs(q).max(initial=0) < 2**15
    return q.astype(np.int16 if small else np.int64).tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * rows * PARTS * width else np.int64
    return np.frombuffer(data, kind).reshape(rows, PARTS, width).astype(np.int64)


def _row(ids: list, labels: list, q: np.ndarray, books: np.ndarray, drift: np.ndarray, heaps: list[Heaps | None]) -> list:
    """A block's row after a round."""
    done = [assign(q[:, p], books[p], drift[p], heaps[p]) for p in range(PARTS)]
    joined = lambda f, kind: np.concatenate([np.asarray(f(h), kind) for h, _, _ in done]).tobytes()
    return [ids, labels, _packed(q), joined(lambda h: h.key, np.float64), joined(lambda h: h.item, np.int32), joined(lambda h: h.start, np.int32), np.stack([c for _, c, _ in done]).tobytes(), sum(n for _, _, n in done)]


def _batch(row: list) -> pa.RecordBatch:
    kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [n.split()[0] for n in _STATE.split(", ")])


def _first(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Deals rows (vec_id, label, embedding) to blocks, and assigns all parts."""
    no_table()
    drift = np.zeros(books.shape[:2])
    ids, labels, parts = [], [], []

    def block() -> pa.RecordBatch:
        out = _batch(_row(ids[:], labels[:], np.concatenate(parts), books, drift, [None] * PARTS))
        ids.clear(), labels.clear(), parts.clear()
        return out

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            if ids and len(ids) + some.num_rows > BLOCK:
                yield block()
            ids += some.column(0).to_pylist()
            labels += some.column(1).to_pylist()
            parts.append(integers(some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)))
    if ids:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch], width: int, entries: int):
    """ids, labels, integers and heaps of each block."""
    for batch in batches:
        for row in batch.select(["ids", "labels", "data", "keys", "items", "starts"]).to_pylist():
            n = len(row["ids"])
            key, item = np.frombuffer(row["keys"]).reshape(PARTS, n), np.frombuffer(row["items"], np.int32).reshape(PARTS, n)
            start = np.frombuffer(row["starts"], np.int32).reshape(PARTS, entries + 1)
            yield row["ids"], row["labels"], _unpacked(row["data"], n, width), [Heaps(key[p], item[p], start[p]) for p in range(PARTS)]


def _next(batches: Iterator[pa.RecordBatch], books: np.ndarray, drift: np.ndarray) -> Iterator[pa.RecordBatch]:
    no_table()
    for ids, labels, q, heaps in _blocks(batches, books.shape[2], books.shape[1]):
        yield _batch(_row(ids, labels, q, books, drift, heaps))


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """vec_id, label, code and error by the assignments of the last round."""
    no_table()
    for ids, labels, q, heaps in _blocks(batches, books.shape[2], books.shape[1]):
        code, error = np.empty((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
        for p, h in enumerate(heaps):
            code[h.item, p] = h.entry()
            error += ((q[:, p] - books[p][code[:, p]]) ** 2).sum(axis=1)
        for at in range(0, len(ids), 1000):
            some = slice(at, at + 1000)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(labels[some], pa.string()), pa.array([bytes(c).hex() for c in code[some]], pa.string()), pa.array(error[some])], ["vec_id", "label", "code", "error"])


def _added(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """A task's changes in all: part and entry in one number, component, change; only what isn't zero."""
    total = np.zeros(shape, np.int64)
    for batch in batches:
        for changes in batch.column(0).to_pylist():
            total += np.frombuffer(changes, np.int64).reshape(shape)
    flat = total.reshape(-1)
    some = np.flatnonzero(flat)
    for at in range(0, len(some), 10_000):
        k = some[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(flat[k])], ["at", "change"])


class Codes:
    """What codes() returns: rows (vec_id, label, code, error), the entries (PARTS, entries, width), and how many parts each assignment measured."""

    def __init__(self, rows: DataFrame, books: np.ndarray, measured: list[int]):
        self.rows, self.books, self.measured = rows, books, measured

    def digest(self) -> str:
        """SHA-256 of all entries' components, decimal, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def codes(vectors: DataFrame) -> Codes | None:
    """Codes of vectors (vec_id, embedding, label); None if no row is kept."""
    spark = vectors.sparkSession
    small_batches(spark)
    kept = pick(vectors, "vec_id", "label", "embedding").where(_good(F.col("embedding")))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return None
    kept = kept.where(F.size("embedding") == len(first[0]["embedding"]))
    starts = kept.select("vec_id", "embedding").orderBy(*order).limit(ENTRIES).collect()  # at most ENTRIES rows
    books = integers(np.array([r["embedding"] for r in starts], np.float64)).transpose(1, 0, 2).copy()
    entries, width = books.shape[1:]
    shape = (PARTS, entries, width + 1)
    drift, totals, measured = np.zeros((PARTS, entries)), np.zeros(shape, np.int64), []
    folder = folder_in(spark, f"heap-lloyd-{uuid.uuid4().hex}")

    def write(n: int, df: DataFrame) -> DataFrame:
        df.write.option("parquet.block.size", GROUP_BYTES).parquet(f"{folder}/{n}")
        return spark.read.parquet(f"{folder}/{n}")

    state = write(0, kept.mapInArrow(lambda batches, b=books: _first(batches, b), _STATE))
    for n in range(ROUNDS + 1):
        measured.append(state.agg(F.sum("measured")).first()[0])
        if n == ROUNDS:
            break
        found = state.select("changes").mapInArrow(lambda batches: _added(batches, shape), "at long, change long").groupBy("at").agg(F.sum("change").alias("change")).toArrow()
        totals.reshape(-1)[found["at"].to_numpy()] += found["change"].to_numpy()
        used, new = totals[:, :, -1] > 0, books.copy()
        new[used] = totals[:, :, :-1][used] // totals[:, :, -1:][used]  # floors
        drift = drift + np.stack([moved(books[p], new[p]) for p in range(PARTS)])
        books = new
        shared = spark.sparkContext.broadcast((books, drift))
        state = write(n + 1, state.mapInArrow(lambda batches, s=shared: _next(batches, *s.value), _STATE))
        remove(spark, f"{folder}/{n}")
    rows = cut(state.mapInArrow(lambda batches, b=books: _codes(batches, b), "vec_id long, label string, code string, error long"))
    if exists(spark, folder):
        remove(spark, folder)
    return Codes(rows, books, measured)


_RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def compressed(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    found = codes(vectors)
    if found is None:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    rows = found.rows
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = cut(rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most).cast("long").alias("label_error")))
    few = sums.count() <= FEW_LABELS
    sums = sums.withColumnRenamed("label", "of")
    joined = rows.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def op13_heap_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Plain Lloyd, each round as two statements."""
    good = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    sql = f"""WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q, len(embedding) // {PARTS} AS w FROM embeddings WHERE {good}),
p AS MATERIALIZED (SELECT vec_id, k AS part, list_slice(q, k * w + 1, k * w + w) AS x FROM v, range({PARTS}) r(k)),
e0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {ENTRIES}))"""
    for n in range(ROUNDS + 1):
        sql += f""",
a{n} AS MATERIALIZED (SELECT vec_id, part, any_value(x) AS x, min(CAST(d AS BIGINT) * {ENTRIES} + entry) AS m FROM (
  SELECT p.vec_id, p.part, p.x, e.entry, list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, e.x) + list_inner_product(e.x, e.x) AS d FROM p JOIN e{n} e USING (part)) GROUP BY vec_id, part)"""
        if n < ROUNDS:
            sql += f""",
m{n} AS (SELECT part, entry, list(c ORDER BY i) AS x FROM (SELECT part, m % {ENTRIES} AS entry, i, CAST(floor(sum(x[i]) / count(*)) AS DOUBLE) AS c FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY ALL) GROUP BY part, entry),
e{n + 1} AS MATERIALIZED (SELECT e.part, e.entry, coalesce(m.x, e.x) AS x FROM e{n} e LEFT JOIN m{n} m USING (part, entry))"""
    last = ROUNDS
    return sql + f""",
c AS (SELECT vec_id, string_agg(lpad(lower(hex(m % {ENTRIES})), 2, '0'), '' ORDER BY part) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{last} GROUP BY vec_id),
s AS (SELECT sha256(string_agg(t, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (SELECT part, entry, array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ',') AS t FROM e{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), s"""


OP13_SQL = _sql()
