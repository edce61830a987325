"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every row is then dealt to a leaf (the nearest centre, level by level). A query
goes through the tree with a priority queue: the node of the greatest estimate, its centre's product plus what its spread
and number of rows let the best row add, is opened next, and leaves are visited in the order in which they come up.
How many leaves a query visits is calibrated: for CALIBRATION queries the true neighbours are found among all rows,
and visits widen until they hold TARGET of these. A query also goes on while it has seen fewer rows than it must return.

Rows and queries meet in tasks of one block of a leaf and one group of queries (a group's queries start at the same
or at neighbouring leaves). The first FIRST leaves give each query a floor, its K-th best score so far; the other
leaves return only what reaches it. Scores are sums of exact products in double precision, always in the same order, so
equal vectors have equal scores. Results are those of a brute-force search over the leaves visited.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without a vec_id; only vectors of the query's length are candidates; rows that share a query's vec_id aren't candidates,
and such an id is asked once, with the least of its vectors; repeated rows are candidates each; equal scores are in the
order of vec_id; a table without queries, or an empty one, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import checkpoint_dir, cut, hash_share, no_table, pick, small_batches, table

K, EVERY = 20, 20
#: Rows of a leaf, aimed at; of a block of a leaf; queries of a group. Leaves at most, and children of a node.
LEAF, BLOCK, GROUP, LEAVES, BRANCH = 1024, 2048, 2048, 2048, 16
#: Rows and numbers that the tree is fitted on, about; least sample rows of a leaf; rounds of k-means.
SAMPLE, SAMPLE_NUMBERS, LEAST, STEPS = 32_768, 1 << 22, 8, 8
#: Queries to calibrate on, and the share of their true neighbours that the visited leaves must hold.
CALIBRATION, TARGET = 256, 0.95
FIRST = 4


class Tree:
    """Nodes of a tree over vectors of one length. Arrays by node; leaf is a leaf's number, -1 for an inner node."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.centre, self.spread, self.size, self.children, self.leaf = [], [], [], [], []
        self.leaves = 0
        self._grow(sample, rows / len(sample), np.random.default_rng(11), max(2, min(LEAVES, -(-rows // LEAF))) if rows > LEAF else 1)
        self.centre = np.array(self.centre)
        # what the best of n rows may add to the centre's product, for a query of length 1
        self.reach = np.array(self.spread) / self.centre.shape[1] ** 0.5 * np.sqrt(2 * np.log(np.maximum(2, self.size)))

    def _grow(self, x: np.ndarray, weight: float, r: np.random.Generator, leaves: int) -> int:
        """The number of the node over x, which may have so many leaves."""
        node = len(self.centre)
        centre = x.mean(axis=0)
        self.centre.append(centre)
        self.spread.append(float(np.sqrt(((x - centre) ** 2).sum(axis=1).mean())))
        self.size.append(len(x) * weight)
        self.children.append([])
        self.leaf.append(-1)
        wanted = min(BRANCH, leaves, len(x) // LEAST)
        parts = _clusters(x, wanted, r) if wanted > 1 and self.spread[node] > 0 else []
        if len(parts) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        for rows in parts:
            child = self._grow(x[rows], weight, r, max(1, round(leaves * len(rows) / len(x))))
            self.children[node].append(child)
        return node

    def deal(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre, level by level."""
        out, open_ = np.empty(len(x), np.int32), [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = np.array(self.children[node])
            near = _gaps(x[rows], self.centre[below]).argmin(axis=1)
            open_ += [(below[k], rows[near == k]) for k in range(len(below))]
        return out

    def estimates(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, about the best score below the node."""
        return queries @ self.centre.T + np.linalg.norm(queries, axis=1)[:, None] * self.reach[None, :]

    def order(self, estimate: np.ndarray) -> Iterator[int]:
        """The leaves best bin first, by a query's estimates."""
        queue = [(-estimate[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (-estimate[child], child))


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, less each row's own square."""
    return (centres**2).sum(axis=1)[None, :] - 2 * (x @ centres.T)


def _clusters(x: np.ndarray, k: int, r: np.random.Generator) -> list[np.ndarray]:
    centres = x[r.choice(len(x), k, replace=False)]
    for _ in range(STEPS):
        near = _gaps(x, centres).argmin(axis=1)
        centres = np.stack([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(k)])
    near = _gaps(x, centres).argmin(axis=1)
    return [rows for j in range(k) if len(rows := np.flatnonzero(near == j))]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


class Forest:
    """A tree for each length of vectors in the sample. Leaves are numbered through; other lengths share the last one."""

    def __init__(self, samples: dict[int, np.ndarray], rows: dict[int, int]):
        self.trees, self.base, at = {}, {}, 0
        for n, x in sorted(samples.items()):
            self.trees[n], self.base[n] = Tree(x, rows[n]), at
            at += self.trees[n].leaves
        self.rest = at

    def deal(self, column: pa.Array) -> np.ndarray:
        sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
        out = np.full(len(sizes), self.rest, np.int32)
        for n in np.unique(sizes):
            if int(n) in self.trees:
                rows = np.flatnonzero(sizes == n)
                out[rows] = self.base[int(n)] + self.trees[int(n)].deal(_matrix(column.take(pa.array(rows))))
        return out

    def orders(self, vectors: list[list[float]]) -> Iterator[Iterator[int]]:
        """For each query its leaves, best bin first."""
        for q in vectors:
            tree = self.trees.get(len(q))
            if tree is None:
                yield iter((self.rest,))
            else:
                yield (self.base[len(q)] + leaf for leaf in tree.order(tree.estimates(np.array([q], np.float64))[0]))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, each summed in the same order wherever it stands."""
    return np.add.reduce(np.ascontiguousarray(a) * b, axis=1)


def best(queries: np.ndarray, asked: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query up to K rows of other ids with the greatest products, floor or more: (query's number, row's number, score).

    Of equal rows only the K + 1 least ids can be in any result, so no more of them are measured."""
    order = np.lexsort((ids, *rows.T[::-1]))
    new = np.concatenate([[True], (rows[order][1:] != rows[order][:-1]).any(axis=1)])
    run = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
    order = order[place <= K]
    x, names = rows[order], ids[order]
    size = np.sqrt((x * x).sum(axis=1)).max()
    found = []
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        s = q @ x.T
        s[asked[at : at + 256, None] == names[None, :]] = -np.inf
        least = np.partition(s, -K, axis=1)[:, -K] if s.shape[1] > K else np.full(len(q), -np.inf)
        margin = 2e-15 * x.shape[1] * size * np.sqrt((q * q).sum(axis=1))  # of the matrix product's rounding
        i, j = np.nonzero((s >= np.maximum(least, floor[at : at + 256])[:, None] - margin[:, None]) & (s > -np.inf))
        for part in range(0, len(i), 1 << 15):
            p, w = i[part : part + (1 << 15)], j[part : part + (1 << 15)]
            found.append((p + at, order[w], products(q[p], x[w])))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    i, j, s = (np.concatenate(c) for c in zip(*found, strict=True))
    enough = s >= floor[i]
    i, j, s = i[enough], j[enough], s[enough]
    by = np.lexsort((ids[j], -s, i))
    i, j, s = i[by], j[by], s[by]
    start = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.empty(0, np.int64)
    few = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i)))) < K
    return i[few], j[few], s[few]


_FOUND = "query_id long, vec_id long, score double"


def _meet(group: pa.Table) -> pa.Table:
    """A block's rows (side 0) and a group's queries (side 1); vectors of one length only meet each other."""
    side, size = group["side"].to_numpy(), group["size"].to_numpy()
    out = []
    for n in np.unique(size[side == 1]):
        rows, asked = (group.filter(pa.array((side == k) & (size == n))) for k in (0, 1))
        if rows.num_rows:
            names = rows["vec_id"].to_numpy()
            i, j, s = best(_matrix(asked["embedding"]), asked["vec_id"].to_numpy(), asked["floor"].to_numpy(), _matrix(rows["embedding"]), names)
            out.append(pa.table({"query_id": asked["vec_id"].to_numpy()[i], "vec_id": names[j], "score": s}))
    return pa.concat_tables(out) if out else pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def _top(found: DataFrame) -> DataFrame:
    """found with rank, up to K."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= K)


class Index:
    """Every row's leaf, the tree, and how many rows each leaf has."""

    def __init__(self, vectors: DataFrame):
        spark = self.spark = vectors.sparkSession
        small_batches(spark)
        odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        good = (F.size("embedding") > 0) & ~odd & F.exists("embedding", lambda x: x != 0)
        rows = pick(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        sizes = {r[0]: r[1] for r in rows.groupBy(F.size("embedding")).count().orderBy(F.desc("count"), F.size("embedding")).limit(BRANCH).collect()}
        self.forest = Forest(self._samples(rows, sizes), sizes)
        shared, kind = spark.sparkContext.broadcast(self.forest), dict(rows.dtypes)["embedding"]

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            no_table()
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.deal(batch.column(1)))], ["vec_id", "embedding", "leaf"])

        self.rows = cut(rows.mapInArrow(deal, f"vec_id long, embedding {kind}, leaf int"))
        self.shared = shared
        #: A leaf's rows: at most LEAVES leaves a length
        self.counts = {r[0]: r[1] for r in self.rows.groupBy("leaf").count().collect()}
        self.blocks, at = {}, 0
        for leaf, n in sorted(self.counts.items()):
            self.blocks[leaf] = (at, -(-n // BLOCK))
            at += self.blocks[leaf][1]

    @staticmethod
    def _samples(rows: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
        """A bounded sample of each of the commonest lengths."""
        out = {}
        for n, count in sizes.items():
            share = min(SAMPLE, SAMPLE_NUMBERS // n) / len(sizes) / count
            some = rows.where((F.size("embedding") == n) & (hash_share("vec_id") < share)).dropDuplicates(["vec_id"]).toArrow()
            if some.num_rows:
                some = some.take(pa.array(np.argsort(some["vec_id"].to_numpy(), kind="stable")))
                out[n] = _matrix(some["embedding"])
        return out

    def queries(self) -> DataFrame:
        """vec_id, embedding, own (rows of that id) of every row whose id is divisible by EVERY."""
        return self.rows.where(F.col("vec_id") % EVERY == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.count("*").alias("own"))

    def true_neighbours(self, queries: list) -> DataFrame:
        """The K neighbours of a bounded list of queries, with their leaves, among all rows."""
        vectors = self.spark.sparkContext.broadcast([(q["vec_id"], q["embedding"]) for q in queries])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            no_table()
            ids, kept = np.array([i for i, _ in vectors.value]), {}
            of = {n: [k for k, (_, v) in enumerate(vectors.value) if len(v) == n] for n in {len(v) for _, v in vectors.value}}
            for batch in batches:
                sizes = np.diff(batch.column(1).offsets.to_numpy())
                for n, which in of.items():
                    rows = np.flatnonzero(sizes == n)
                    if not len(rows):
                        continue
                    some = batch.take(pa.array(rows))
                    names, leaves = some.column(0).to_numpy(), some.column(2).to_numpy()
                    floor = np.array([kept[k][-1][0] if len(kept.get(k, ())) == K else -np.inf for k in which])
                    i, j, s = best(np.array([vectors.value[k][1] for k in which], np.float64), ids[which], floor, _matrix(some.column(1)), names)
                    for k in np.unique(i):
                        own = i == k
                        more = [(float(score), int(name), int(leaf)) for score, name, leaf in zip(s[own], names[j[own]], leaves[j[own]], strict=True)]
                        kept[which[k]] = sorted(kept.get(which[k], []) + more, key=lambda f: (-f[0], f[1]))[:K]
            flat = [(int(ids[k]), name, score, leaf) for k, found in kept.items() for score, name, leaf in found]
            if flat:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat, strict=True)], ["query_id", "vec_id", "score", "leaf"])

        return _top(self.rows.mapInArrow(scan, _FOUND + ", leaf long"))

    def calibrate(self, queries: DataFrame) -> tuple[int, float]:
        """The number of leaves that a query visits, and the recall reached on the queries it was chosen by."""
        some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
        wanted: dict[int, list[int]] = {}
        for r in self.true_neighbours(some).select("query_id", "leaf").collect():  # K rows a query
            wanted.setdefault(r[0], []).append(r[1])
        places = []
        for q, order in zip(some, self.forest.orders([q["embedding"] for q in some]), strict=True):
            place = {leaf: n for n, leaf in enumerate(order)}
            places += [place[leaf] for leaf in wanted.get(q["vec_id"], [])]
        visits = 1
        while places and sum(p < visits for p in places) < TARGET * len(places):
            visits += max(1, visits // 8)
        return visits, sum(p < visits for p in places) / max(1, len(places))

    def search(self, queries: DataFrame, visits: int) -> DataFrame:
        """query_id, vec_id, score, rank: the K best rows of the leaves that each query visits."""
        blocks, counts, shared = self.blocks, self.counts, self.shared
        kind = dict(queries.dtypes)["embedding"]

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            no_table()
            for batch in batches:
                near, far, start = [], [], []
                for own, order in zip(batch.column(2).to_pylist(), shared.value.orders(batch.column(1).to_pylist()), strict=True):
                    seen, went = -own, []
                    for leaf in order:
                        went.append(leaf)
                        seen += counts.get(leaf, 0)
                        if len(went) >= visits and seen >= K:
                            break
                    spread = [[b for leaf in part if leaf in blocks for b in range(blocks[leaf][0], sum(blocks[leaf]))] for part in (went[:FIRST], went[FIRST:])]
                    near.append(spread[0]), far.append(spread[1]), start.append(went[0])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.list_(pa.int32())), pa.array(far, pa.list_(pa.int32())), pa.array(start, pa.int32())], ["vec_id", "embedding", "near", "far", "start"])

        routed = cut(queries.select("vec_id", "embedding", "own").mapInArrow(route, f"vec_id long, embedding {kind}, near array<int>, far array<int>, start int"))
        # groups of queries: by their first leaf, in the order of leaves, about GROUP each
        starts, at, places = {r[0]: r[1] for r in routed.groupBy("start").count().collect()}, 0, []
        for leaf, n in sorted(starts.items()):
            places.append((leaf, at, n))
            at += n
        if not places:
            return self.spark.createDataFrame([], _FOUND + ", rank int")
        places = F.broadcast(self.spark.createDataFrame(places, "start int, at long, n long"))
        group = F.floor((F.col("at") + F.pmod(F.xxhash64("vec_id"), F.col("n"))) / GROUP).cast("int")
        routed = routed.join(places, "start").withColumn("group", group)
        of_leaf = F.broadcast(self.spark.createDataFrame([(leaf, b, n) for leaf, (b, n) in blocks.items()], "leaf int, first int, n int"))
        rows = self.rows.join(of_leaf, "leaf").select("vec_id", "embedding", (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("n"))).cast("int").alias("block"))

        def meet(asked: DataFrame) -> DataFrame:
            """asked: vec_id, embedding, group, floor, block."""
            here = rows.join(asked.select("block", "group").distinct(), "block")
            both = here.select("block", "group", "vec_id", "embedding", F.size("embedding").alias("size"), F.lit(0).alias("side"), F.lit(0.0).alias("floor")).unionByName(
                asked.select("block", "group", "vec_id", "embedding", F.size("embedding").alias("size"), F.lit(1).alias("side"), "floor")
            )
            return both.groupBy("block", "group").applyInArrow(_meet, _FOUND)

        least = F.lit(float("-inf"))
        first = cut(meet(routed.select("vec_id", "embedding", "group", least.alias("floor"), F.explode("near").alias("block"))))
        floors = _top(first).where(F.col("rank") == K).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        rest = routed.join(floors, "vec_id", "left").select("vec_id", "embedding", "group", F.coalesce("floor", least).alias("floor"), F.explode("far").alias("block"))
        return _top(first.unionByName(meet(rest)))


def neighbours(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest K found of every query."""
    checkpoint_dir(vectors.sparkSession)
    index = Index(vectors)
    queries = cut(index.queries())
    visits, _ = index.calibrate(queries)
    return index.search(queries, visits).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
