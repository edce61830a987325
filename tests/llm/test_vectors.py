"""Vector codes and nearest neighbours against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from nomograph.llm import heap_lloyd, kmeans_tree
from nomograph.llm.registry import ORACLE_SQL, QUERIES
from tests.conftest import DATA
from tests.llm.helpers import EXTRA
from tests.oracle import connect, same

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d, seed, clusters=0):
    r = np.random.default_rng(seed)
    x = r.normal(0, 0.2, (n, d))
    if clusters:
        x = 0.2 * x + r.normal(0, 1, (clusters, d))[r.integers(0, clusters, n)]
    return [(i, [float(v) for v in row.astype(np.float32)], i % 3 or None) for i, row in enumerate(x)]


# --- vector codes ---


def lloyd(rows, entries=256, rounds=4):
    """Plain Lloyd in whole numbers: every part against every entry, every round."""
    kept = [(i, [math.floor(1024 * v) for v in e], lab) for i, e, lab in rows if e and all(v is not None and math.isfinite(v) for v in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    w = -(-len(kept[0][1]) // 4)
    parts = [np.array([q[k * w : k * w + w] + [0] * (w - len(q[k * w : k * w + w])) for _, q, _ in kept], dtype=object) for k in range(4)]
    books = [p[:entries].copy() for p in parts]

    def assigned(p, b):
        return [min((sum((x - y) ** 2 for x, y in zip(v, e, strict=True)), k) for k, e in enumerate(b)) for v in p]

    for _ in range(rounds):
        for p, b in zip(parts, books, strict=True):
            found = assigned(p, b)
            for k in range(len(b)):
                own = [v for v, (_, e) in zip(p, found, strict=True) if e == k]
                if own:
                    b[k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [assigned(p, b) for p, b in zip(parts, books, strict=True)]
    error = [sum(f[n][0] for f in last) for n in range(len(kept))]
    by_label = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{f[n][1]:02x}" for f in last), error[n], by_label[lab], digest) for n, (i, _, lab) in enumerate(kept)), key=str)


def coded(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in heap_lloyd.compressed(spark.createDataFrame(rows, schema)).collect()), key=str)


@pytest.mark.parametrize("case", ["spread", "clusters", "few", "odd length", "wide"])
def test_codes_are_those_of_plain_lloyd(spark, monkeypatch, case):
    monkeypatch.setattr(heap_lloyd, "BLOCK", 64)
    monkeypatch.setattr(heap_lloyd, "ENTRIES", 16)
    rows = {"spread": lambda: vectors(400, 8, 1), "clusters": lambda: vectors(400, 8, 2, clusters=9), "few": lambda: vectors(5, 8, 3), "odd length": lambda: vectors(120, 10, 4), "wide": lambda: [(i, [float(np.float32(v * 3e4)) for v in e], lab) for i, e, lab in vectors(150, 8, 5)]}[case]()
    assert coded(spark, rows) == lloyd(rows, 16)


def test_codes_of_ties_repeated_rows_and_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(heap_lloyd, "BLOCK", 50)
    monkeypatch.setattr(heap_lloyd, "ENTRIES", 8)
    r = random.Random(3)
    grid = [(i, [r.choice([0.0, 0.5, -0.5]) for _ in range(8)], r.choice([None, 1, 2])) for i in range(200)]
    rows = grid + grid[:30] + [(900, None, 1), (901, [], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] + [0.0] * 7, 1), (904, [None] + [0.0] * 7, 1), (905, [0.0] * 8, None), (None, [0.25] * 8, 2)]
    assert coded(spark, rows) == lloyd(rows, 8)
    assert coded(spark, [*rows, (950, [1.0, 2.0], 1)]) == lloyd(rows, 8)  # another length
    assert heap_lloyd.compressed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert heap_lloyd.compressed(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []


def test_codes_bound_huge_components_and_ignore_other_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in (*EXTRA, "code", "error", "of", "ids", "data")])
    assert [(r.vec_id, r.code, r.error) for r in heap_lloyd.compressed(df).orderBy("vec_id").collect()] == [(1, "00000000", 0), (2, "01010101", 0), (3, "02020202", 0)]


def test_labels_by_a_shuffle(spark, monkeypatch):
    rows = vectors(90, 8, 6)
    whole = coded(spark, rows)
    monkeypatch.setattr(heap_lloyd, "FEW_LABELS", 0)
    assert coded(spark, rows) == whole == lloyd(rows)


def test_heaps_spare_measuring(spark, monkeypatch):
    """On clustered vectors most parts are measured once or twice: later they stay in their heaps."""
    monkeypatch.setattr(heap_lloyd, "ENTRIES", 16)
    found = heap_lloyd.codes(spark.createDataFrame(vectors(3000, 16, 7, clusters=12), SCHEMA))
    assert found.measured[0] == 12_000 and len(found.measured) == 5
    assert max(found.measured[-2:]) < 0.25 * found.measured[0]


def test_codes_query(spark):
    assert same(QUERIES["op13_heap_lloyd"](spark, DATA), connect(DATA), ORACLE_SQL["op13_heap_lloyd"]) == 500


# --- nearest neighbours ---


def good(e):
    return bool(e) and all(v is not None and math.isfinite(v) for v in e) and any(e)


def nearest(rows, k=20):
    """query -> [(vec_id, score)] by exact sums."""
    rows = [(i, e) for i, e, *_ in rows if i is not None and good(e)]
    out = {}
    for q in sorted({i for i, _ in rows if i % 20 == 0}):
        v = min(e for i, e in rows if i == q)
        found = sorted((-math.fsum(a * b for a, b in zip(v, e, strict=True)), i) for i, e in rows if i != q and len(e) == len(v))
        out[q] = [(i, -s) for s, i in found[:k]]
    return {q: f for q, f in out.items() if f}


def searched(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def close(got, true):
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in true.items()}
    for q, found in got.items():
        assert np.allclose([s for _, s in found], [s for _, s in true[q]], rtol=1e-12, atol=1e-12)


def small_leaves(monkeypatch, **values):
    for name, value in ({"LEAF": 32, "BLOCK": 24, "GROUP": 7, "BRANCH": 4} | values).items():
        monkeypatch.setattr(kmeans_tree, name, value)


def test_search_query(spark):
    """One leaf: exact."""
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op11_kmeans_tree"](spark, DATA)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    close(searched(got), nearest(rows))


@pytest.mark.parametrize(("clusters", "least"), [(0, 0.9), (30, 0.9)])
def test_recall_by_calibrated_visits(spark, monkeypatch, clusters, least):
    small_leaves(monkeypatch)
    monkeypatch.setattr(kmeans_tree, "CALIBRATION", 40)
    rows = vectors(2000, 16, 8, clusters)
    df = spark.createDataFrame(rows, SCHEMA)
    index = kmeans_tree.Index(df)
    visits, reached = index.calibrate(index.queries())
    assert len(index.counts) > 30 and visits < len(index.counts) and reached >= 0.95
    got, true = searched(kmeans_tree.neighbours(df)), nearest(rows)
    assert set(got) == set(true) and all(len(f) == 20 for f in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true) >= least * 20 * len(true)
    assert searched(kmeans_tree.neighbours(df.repartition(3))) == got  # reruns agree


def test_all_leaves_are_an_exact_search(spark, monkeypatch):
    small_leaves(monkeypatch)
    rows = vectors(900, 12, 9)
    index = kmeans_tree.Index(spark.createDataFrame(rows, SCHEMA))
    close(searched(index.search(index.queries(), 10_000)), nearest(rows))


def test_search_of_ties_copies_and_awkward_vectors(spark, monkeypatch):
    """A third of all rows is one vector; there are vectors without ids, of other lengths, without components; ids shared by rows."""
    from pyspark.sql import functions as F

    small_leaves(monkeypatch, TARGET=1.0)
    r = random.Random(5)
    grid = [[float(r.choice([-1, 0, 1])) for _ in range(6)] for _ in range(400)]
    rows = [(i, e if i % 3 else [1.0, 0.5, 0.0, 0.0, 0.0, -1.0], 1) for i, e in enumerate(grid)]
    rows += rows[:25] + [(20, [9.0] * 6, 1), (2000, None, 1), (2020, [], 1), (2040, [0.0] * 6, 1), (2060, [float("nan")] * 6, 1), (2080, [float("inf")] * 6, 1), (2100, [None, 1.0], 1), (None, [3.0] * 6, 1), (2120, [1.0, 2.0], 1), (2121, [1.0, 3.0], 1), (2140, [4.0, 1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in (*EXTRA, "leaf", "score", "rank", "query_id", "block")])
    index = kmeans_tree.Index(df)
    close(searched(index.search(index.queries(), 10_000)), nearest(rows))
    got, true = searched(kmeans_tree.neighbours(df)), nearest(rows)
    assert {q: len(f) for q, f in got.items()} == {q: len(f) for q, f in true.items()}
    assert kmeans_tree.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    assert kmeans_tree.neighbours(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).collect() == []
    assert kmeans_tree.neighbours(spark.createDataFrame([(20, [1.0], 1)], SCHEMA)).collect() == []


def test_equal_vectors_have_equal_scores():
    r = np.random.default_rng(1)
    x = r.normal(size=(70, 64))
    rows = np.concatenate([x, x, x])
    order = r.permutation(len(rows))
    _, j, s = kmeans_tree.best(x[:5], np.full(5, -1), np.full(5, -np.inf), rows[order], order.astype(np.int64))
    for k in range(5):
        found = [(-score, order[n]) for score, n in zip(s[k * 20 : k * 20 + 20], j[k * 20 : k * 20 + 20], strict=True)]
        assert found == sorted(found)
        assert len({order[n] % 70 for n in j[k * 20 : k * 20 + 20]}) == 7  # three equal rows each
