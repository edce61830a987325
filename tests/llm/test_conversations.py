"""Repair of conversations against a plain recursion over whole edit strings."""

import functools
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from nomograph.llm import conversations
from nomograph.llm.registry import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import EXTRA

SCHEMA = "conv_id long, turn long, role string, text string"
ROW = dict[str, object]


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, by conversation; conversations that lose all stay as empty lists."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        found[conv] += []
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        role = "user" if fault == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        found[conv] += [(turn is not None, turn or 0, digest, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: [r[3:] for r in sorted(rs, key=lambda r: r[:3])] for c, rs in found.items()}


def cheapest(rows):
    """The least (cost, audit, lines) by recursion over (row, state)."""
    n, faults, seen = len(rows), [], set()
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == n and state in ("", "a") else []
        for role in ("user", "assistant"):
            if inserts and role[0] in follows[state]:
                c, audit, lines = best(i, role[0], inserts - 1)
                found.append((c + 5, "I" + audit, (role + ":", *lines)))
        if i < n:
            _, role, text = rows[i]
            c, audit, lines = best(i + 1, state, 2)
            found.append((c + 2, "D" + audit, lines))
            if faults[i] not in ("b", "d"):
                more = 5 if faults[i] == "t" else 0
                for letter, to, cost in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if to and to[0] in follows[state]:
                        c, audit, lines = best(i + 1, to[0], 2)
                        found.append((c + cost + more, letter + audit, (f"{to}:{text}", *lines)))
        return min(found, default=(10**9, "~", ()))

    best_of = None
    for i in range(n, -1, -1):  # shallow recursion
        for state in ("", "s", "u", "a"):
            best_of = best(i, state, 2)
            if (i, state) == (0, ""):
                found = best_of
    return faults, found


def brute(rows):
    out = set()
    for conv, kept in damaged(rows).items():
        faults, (cost, audit, lines) = cheapest(kept)
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        out.add((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def made(r, conversations_, longest):
    rows = []
    for conv in range(conversations_):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ux"])
            if r.random() < 0.7:
                role = ("user", "assistant")[turn % 2]
            rows.append((None if conv == 3 else conv, r.choice([turn, turn, turn, turn + 1, None]), role, r.choice(["Yes.", "No!", "cut off", "", " \n", None, "Why? \t", "é。", f"text {r.randint(0, 5)}."])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_recursion(spark, seed):
    rows = made(random.Random(seed), 120, 9)
    got = conversations.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len({r[0] for r in rows})


def test_conversations_that_lie_in_many_partitions(spark, monkeypatch):
    """A conversation of most rows, and one that is a single row many times."""
    r = random.Random(4)
    rows = [(7, t, ("user", "assistant")[t % 2] if r.random() < 0.8 else "system", r.choice([f"a {t}.", f"b {t}", "same.", ""])) for t in range(900)] + [(8, 5, "user", "Again.")] * 200 + made(r, 20, 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = conversations.cut(conversations._faults(conversations.damage(spark.createDataFrame(rows, SCHEMA))).repartitionByRange(4, "conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest"))
        ends = found.mapInArrow(conversations._ends, "part int, conv long, costs array<double>, initial string").collect()
        assert sum(e.conv == 7 for e in ends) >= 3
        got = conversations.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {tuple(x) for x in got} == brute(rows)


def test_tight_arcs_are_the_optimal_ones():
    """Each arc is on some cheapest path exactly if it is tight."""
    rows = [("u", 0), ("u", 0), ("a", 3), ("s", 0), ("a", 1)]
    masks, behind = conversations.tight(rows, conversations.START, conversations.END)
    f, b = conversations.forward(rows, conversations.START), conversations.backward(rows, conversations.END)
    assert all(masks) and f[-1][0] + 0 >= b[0][0] == min(f[-1][q] for q in (0, 3))
    # a stretch cut in two has the same arcs
    for cut in range(len(rows) + 1):
        first, rest = rows[:cut], rows[cut:]
        left, _ = conversations.tight(first, conversations.START, conversations.backward(rest, conversations.END)[0])
        right, end = conversations.tight(rest, conversations.forward(first, conversations.START)[-1], conversations.END)
        assert (left + right, end) == (masks, behind)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, DATA)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_defined_cases(spark):
    from pyspark.sql import functions as F

    assert conversations.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = made(random.Random(9), 30, 4) + [(50, 1, "user", "x" * 400_000 + "."), (50, 2, "assistant", "y" * 400_000 + "?")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in (*EXTRA, "digest", "times", "kind", "masks", "seq", "initial", "fault")])
    assert {tuple(r) for r in conversations.repaired(df).collect()} == brute(rows)
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in conversations.repaired(spark.createDataFrame(gone, SCHEMA)).collect()} == {(c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone}
