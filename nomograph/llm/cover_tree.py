"""Near-duplicate embeddings: all pairs with cosine of at least THRESHOLD, by dual traversal of cover trees.

On unit vectors the cosine bound is a bound T on the Euclidean distance. Vectors are dealt to the nearest of at
most PIVOTS pivots (the top level), and large cells to blocks by hash, of a number of vectors that grows with the table
between bounds. A block travels as one row of packed numbers. Each block gets
a tree of nested levels whose radii halve from 1 to 1/8; every node keeps its true covering radius. Two cells, and
then two nodes, are left out if their centres' distance less both radii exceeds T, are linked as a whole if that
distance plus both radii is within T, and are opened otherwise; vectors in leaves are compared in double
precision, first over the HEAD components of the greatest variance: what these give and the lengths of the rest bound the
cosine, and only pairs whose bound reaches THRESHOLD are compared whole. Where radii prune little, as on vectors without
structure, a product of matrices in single precision, with its error as a margin, first takes out the top nodes that
have no vectors so near; the traversal then visits the others only. A traversal yields counts and a spanning forest of the links, never the pairs themselves.

Equal vectors form a class, counted through its one representative.

Defined cases: vectors that are null, empty, zero, or hold nulls or non-finite numbers link with nothing;
vectors of different lengths don't link; repeated rows are links of each other; a row without vec_id links as any
other, but names no component (its kept is null, as vec_id = component_id is), and where all rows of a vector have none they have no links; rows that share a vec_id
but not the vector are each judged by their own vector; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm.common import checkpoint_dir, cut, pick, small_batches, table
from nomograph.llm.components import connected

THRESHOLD = 0.95
#: Pivots of the top level; their number follows the data up to this bound.
PIVOTS = 512
#: Vectors of a block: a BLOCKS-th of the table, from BLOCK to BLOCK_MOST, and the bytes that they may take.
BLOCKS, BLOCK, BLOCK_MOST, BLOCK_BYTES = 16, 4096, 32_768, 16 << 20
RADII = (1.0, 0.5, 0.25, 0.125)
#: Components by which pairs of a leaf are looked at first: this share of them.
HEAD = 0.25
#: Pairs opened at a time.
OPEN = 60_000
#: Top nodes are looked at through their vectors if a node has fewer than FEW of them, or if centres leave more than OPENED of the vectors' pairs;
#: no longer if more than MANY of these are near, as then whole nodes are linked. TILE: vectors whose products are made at a time.
FEW, OPENED, MANY, TILE = 4, 0.05, 0.02, (256, 2048)
#: Tasks at most that pairs of blocks are dealt to.
TASKS = 1024
_EPS = 1e-9


def _reach() -> float:
    return (2 - 2 * THRESHOLD) ** 0.5


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def build(u: np.ndarray) -> np.ndarray:
    """For each unit vector the number of its centre at each level; a level's nodes lie within those above."""
    path = np.zeros((len(u), len(RADII)), np.int32)
    groups = [np.arange(len(u))]
    for level, radius in enumerate(RADII):
        near, below = 1 - radius * radius / 2, []
        for rows in groups:
            left = rows
            while len(left):
                heads = left[:128]
                cos = u[heads] @ u[left].T
                free = np.ones(len(left), bool)
                for i in range(len(heads)):
                    if free[i]:  # heads are the first of left
                        own = free & (cos[i] >= near)
                        own[i] = True
                        path[left[own], level] = heads[i]
                        below.append(left[own])
                        free &= ~own
                left = left[free]
        groups = below
    return path


class Tree:
    """A block's nodes by level, in an order in which each node is a range of vectors and of nodes below."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, x: np.ndarray, path: np.ndarray, spread: np.ndarray | None = None):
        """spread: the components' numbers by falling variance, the same for all trees that meet."""
        order = np.lexsort(path.T[::-1])
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        self.ids, self.counts, self.u = ids[order], counts[order], _unit(x)[order]
        first = (np.arange(x.shape[1]) if spread is None else spread)[: max(1, round(HEAD * x.shape[1]))]
        self.head = np.ascontiguousarray(self.u[:, first])
        self.rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", self.head, self.head)))
        self.u32 = self.u.astype(np.float32)
        path, n = path[order], len(order)
        self.centre, self.radius, self.low, self.high = [], [], [], []
        starts = []
        for level in range(len(RADII)):
            first = np.flatnonzero(np.concatenate([[True], (path[1:, : level + 1] != path[:-1, : level + 1]).any(axis=1)]))
            centre = where[path[first, level]]
            size = np.diff(np.append(first, n))
            gap = 1 - np.einsum("ij,ij->i", self.u, self.u[np.repeat(centre, size)])
            self.centre.append(centre)
            self.radius.append(np.sqrt(np.maximum(0, 2 * np.maximum.reduceat(gap, first))) + _EPS)
            starts.append(first)
        for level in range(len(RADII)):
            under = np.arange(n) if level == len(RADII) - 1 else starts[level + 1]
            self.low.append(np.searchsorted(under, starts[level]))
            self.high.append(np.append(self.low[-1][1:], len(under)))
        self.starts = [np.append(s, n) for s in starts]
        self.top = np.repeat(np.arange(len(starts[0])), np.diff(self.starts[0]))


class Traversal:
    """Links between two trees, or within one: each vector's count of linked rows, and a forest of the links."""

    def __init__(self, a: Tree, b: Tree | None):
        self.a, self.b, self.same, self.t = a, b or a, b is None, _reach()
        self.shift = 0 if self.same else len(a.ids)
        self.parent = np.arange(len(a.ids) + (0 if self.same else len(b.ids)))
        self.linked = np.zeros(len(self.parent), np.int64)
        self._top()

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        j = j + self.shift
        while True:
            ri, rj = self.parent[i], self.parent[j]
            open_ = ri != rj
            if not open_.any():
                return
            i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
            np.minimum.at(self.parent, np.maximum(ri, rj), np.minimum(ri, rj))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up

    def _top(self) -> None:
        a, b = self.a, self.b
        # in single precision, with its error as a margin: _visit measures what is left in double
        ua, ub = a.u32[a.centre[0]], b.u32[b.centre[0]]
        margin = 1e-6 + 1.2e-7 * ua.shape[1]
        ra, rb = (self.t + a.radius[0]).astype(np.float32), b.radius[0].astype(np.float32)
        na, nb = np.diff(a.starts[0]), np.diff(b.starts[0])
        small = len(na) * len(nb) * FEW * FEW > len(a.ids) * len(b.ids)
        for at in range(0, len(ua), 512):
            to = min(at + 512, len(ua))
            found = self._met(at, to, THRESHOLD - margin) if small else None
            if found is None:
                reach = np.minimum(np.float32(2), ra[at:to, None] + rb[None, :])
                reach *= reach
                reach *= np.float32(-0.5)
                reach += np.float32(1 - margin)
                i, j = np.nonzero(ua[at:to] @ ub.T >= reach)
                i += at
                if self.same:
                    keep = i <= j
                    i, j = i[keep], j[keep]
                if not small and (na[i] * nb[j]).sum() > OPENED * na[at:to].sum() * len(b.ids):
                    found = self._met(at, to, THRESHOLD - margin)
                    if found is not None:  # pairs of nodes that both the centres and the vectors leave
                        both = np.intersect1d(i * len(nb) + j, found[0] * len(nb) + found[1], assume_unique=True)
                        found = np.divmod(both, len(nb))
            self._visit(0, *(found or (i, j)))

    def _met(self, at: int, to: int, least: float) -> tuple[np.ndarray, np.ndarray] | None:
        """The pairs of top nodes, i of a from at to to, with vectors whose product is least or more. None if that is so of very many."""
        a, b = self.a, self.b
        codes, hits, seen = [], 0, 0
        end = int(a.starts[0][to])
        for x in range(int(a.starts[0][at]), end, TILE[0]):
            rows = a.u32[x : min(x + TILE[0], end)]
            for y in range(x if self.same else 0, len(b.ids), TILE[1]):
                cos = rows @ b.u32[y : y + TILE[1]].T
                seen += cos.size
                if cos.max() < least:
                    continue
                p, q = np.nonzero(cos >= least)
                if self.same:  # each pair once, and none of a vector with itself
                    keep = p + x < q + y
                    p, q = p[keep], q[keep]
                hits += len(p)
                if hits > OPEN + MANY * seen:
                    return None
                codes.append(np.unique(a.top[p + x] * len(b.starts[0]) + b.top[q + y]))
        return np.divmod(np.unique(np.concatenate(codes)), len(b.starts[0])) if codes else (np.empty(0, np.int64), np.empty(0, np.int64))

    def _visit(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of nodes of a level, or of vectors below the last; in one tree, each pair once and i <= j."""
        if not len(i):
            return
        a, b = self.a, self.b
        if level == len(RADII):
            if self.same:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), OPEN):
                p, q = i[at : at + OPEN], j[at : at + OPEN]
                near = np.einsum("ij,ij->i", a.head[p], b.head[q]) + a.rest[p] * b.rest[q] >= THRESHOLD - _EPS
                p, q = p[near], q[near]
                hit = np.einsum("ij,ij->i", a.u[p], b.u[q]) >= THRESHOLD
                self._link(p[hit], q[hit])
            return
        d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", a.u[a.centre[level][i]], b.u[b.centre[level][j]])))
        both = a.radius[level][i] + b.radius[level][j]
        own = (i == j) & self.same
        whole = d + both <= self.t - 1e-7
        for p, q in zip(i[whole], j[whole], strict=True):
            self._link_all(a.starts[level][p], a.starts[level][p + 1], b.starts[level][q], b.starts[level][q + 1], self.same and p == q)
        opened = ~whole & (own | (d - both <= self.t + 1e-7))
        i, j = i[opened], j[opened]
        wide = b.high[level][j] - b.low[level][j]
        size = (a.high[level][i] - a.low[level][i]) * wide
        upto = np.cumsum(size)
        at = 0
        while at < len(i):  # as many pairs as open to about OPEN below, one at least
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + OPEN, "right")))
            s, w = size[at:to], np.repeat(wide[at:to], size[at:to])
            k = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            p, q = np.repeat(a.low[level][i[at:to]], s) + k // w, np.repeat(b.low[level][j[at:to]], s) + k % w
            if self.same:
                keep = p <= q
                p, q = p[keep], q[keep]
            for part in range(0, len(p), 8 * OPEN):
                self._visit(level + 1, p[part : part + 8 * OPEN], q[part : part + 8 * OPEN])
            at = to

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            n = len(self.parent)
            self.linked += np.bincount(i, self.b.counts[j], n).astype(np.int64) + np.bincount(j + self.shift, self.a.counts[i], n).astype(np.int64)
            self._join(i, j)

    def _link_all(self, i0: int, i1: int, j0: int, j1: int, own: bool) -> None:
        i, j = np.arange(i0, i1), np.arange(j0, j1)
        if own:
            self.linked[i0:i1] += self.a.counts[i0:i1].sum() - self.a.counts[i0:i1]
        else:
            self.linked[i0:i1] += self.b.counts[j0:j1].sum()
            self.linked[j0 + self.shift : j1 + self.shift] += self.a.counts[i0:i1].sum()
        self._join(np.full(len(j), i0), j)
        self._join(i, np.full(len(i), j0))

    def result(self) -> pa.Table:
        ids = self.a.ids if self.same else np.concatenate([self.a.ids, self.b.ids])
        hit = self.linked > 0
        return pa.table({"rep": ids[hit], "n": self.linked[hit], "root": ids[self.parent[hit]]})


#: A block as one row: its numbers of rep, rows, embedding (in its own type) and path, packed.
_PACKED = "cell int, salt int, size int, reps binary, counts binary, vectors binary, paths binary"


def _planted(block: pa.Table) -> pa.Table:
    """A block's vectors, with the tree's levels, as one row."""
    wide = block["embedding"].type.value_type
    x = _matrix(block["embedding"])
    packed = (block["rep"].to_numpy().astype("<i8"), block["rows"].to_numpy().astype("<i8"), x.astype("<f4") if pa.types.is_float32(wide) else x.astype("<f8"), build(_unit(x)).astype("<i4"))
    one = {c: block[c].slice(0, 1).cast(pa.int32()) for c in ("cell", "salt", "size")}
    return pa.table(one | {c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("reps", "counts", "vectors", "paths"), packed, strict=True)})


def _tree(block: pa.Table, spreads: dict[int, np.ndarray]) -> Tree:
    ids, counts = (np.frombuffer(block[c][0].as_py(), "<i8") for c in ("reps", "counts"))
    size, data = block["size"][0].as_py(), block["vectors"][0].as_py()
    x = np.frombuffer(data, f"<f{len(data) // (len(ids) * size)}").astype(np.float64).reshape(len(ids), size)
    return Tree(ids, counts, x, np.frombuffer(block["paths"][0].as_py(), "<i4").astype(np.int64).reshape(len(ids), -1), spreads.get(size))


def _pair(block: pa.Table, spreads: dict[int, np.ndarray]) -> pa.Table:
    side = block["side"].to_numpy()
    within = block["i"][0].as_py() == block["j"][0].as_py() and block["s"][0].as_py() == block["z"][0].as_py()
    if not within and side.all() or not within and not side.any():
        return pa.table({"rep": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    a, b = (None if within and k else _tree(block.filter(pa.array(side == k)), spreads) for k in (0, 1))
    return Traversal(a, b).result()


def _block(total: int, size: int) -> int:
    """How many vectors of a length a block has in a table of so many."""
    return max(1, min(max(BLOCK, min(BLOCK_MOST, total // BLOCKS)), BLOCK_BYTES // (8 * max(1, size))))


def _cells(reps: DataFrame, total: int) -> tuple[DataFrame, list[tuple[int, int, int, int]], dict[int, np.ndarray]]:
    """reps with cell and salt, dealt by block; the pairs of cells that may hold a link: i <= j, and each cell's number of salts; and for each length its components by falling variance among the pivots. Pivots, radii and pairs are bounded by PIVOTS, not by the data."""
    spark = reps.sparkSession
    wanted = max(1, min(PIVOTS, -(-total // _block(total, 1))))
    chosen = [(r[0], np.array(r[1], float)) for r in reps.select("size", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(wanted).collect()]
    sizes = [r[0] for r in reps.select("size").distinct().orderBy("size").limit(PIVOTS).collect()]
    pivots = {n: _unit(np.stack([v for k, v in chosen if k == n])) for n in {k for k, _ in chosen}}
    spreads = {n: np.argsort(-p.var(axis=0), kind="stable") for n, p in pivots.items()}
    first, cells = {}, 0
    for n in sizes:  # a size without a pivot has one cell, of the greatest radius
        first[n] = cells
        cells += len(pivots.get(n, [0]))
    other = cells  # of sizes beyond the bound
    shared = spark.sparkContext.broadcast((pivots, first))

    def deal(batches):
        pivots, first = shared.value
        for batch in batches:
            size = batch.column(batch.schema.get_field_index("size")).to_numpy()
            cell, gap = np.full(len(size), other, np.int32), np.full(len(size), 2.0)
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                cell[rows] = first.get(int(n), other)
                if int(n) in pivots:
                    cos = _unit(_matrix(batch.column(batch.schema.get_field_index("embedding")).take(pa.array(rows)))) @ pivots[int(n)].T
                    cell[rows] += cos.argmax(axis=1).astype(np.int32)
                    gap[rows] = np.sqrt(np.maximum(0, 2 - 2 * cos.max(axis=1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(gap)], [*batch.schema.names, "cell", "gap"])

    kind = dict(reps.dtypes)["embedding"]
    dealt = cut(reps.select("rep", "rows", "size", "embedding").mapInArrow(deal, f"rep long, rows long, size int, embedding {kind}, cell int, gap double"))
    known = {r[0]: (r[1], r[2], r[3], r[4]) for r in dealt.groupBy("cell").agg(F.count("*"), F.max("gap"), F.min("size"), F.max("size")).collect()}
    salts = {c: -(-n // _block(total, known[c][3])) for c, (n, *_) in known.items()}
    pairs = []
    for i in known:
        for j in known:
            n = known[i][2]
            if i < j and (n != known[j][2] or n not in pivots or np.linalg.norm(pivots[n][i - first[n]] - pivots[n][j - first[n]]) - known[i][1] - known[j][1] > _reach() + 1e-7):
                continue
            if i <= j:
                pairs.append((i, j, salts[i], salts[j]))
    many = F.create_map(*[F.lit(x) for c, n in salts.items() for x in (c, n)]) if salts else F.create_map().cast("map<int,int>")
    salted = dealt.drop("gap").withColumn("salt", F.pmod(F.xxhash64("rep", F.lit(1)), many[F.col("cell")]).cast("int"))
    return salted.repartition(max(1, sum(salts.values())), "cell", "salt", "size"), pairs, spreads


def near_pairs(reps: DataFrame) -> DataFrame:
    """reps: rep, rows, size, embedding. rep, n (linked rows of other classes), root (a vector of the same component) for each traversal in which the vector has a link."""
    small_batches(reps.sparkSession)
    dealt, met, spreads = _cells(reps, reps.count())
    # blocks of differing lengths of vectors share a cell only beyond PIVOTS lengths; size keeps them apart
    planted = cut(dealt.groupBy("cell", "salt", "size").applyInArrow(_planted, _PACKED))
    pairs = F.broadcast(reps.sparkSession.createDataFrame(met, "i int, j int, ni int, nj int"))
    one = planted.join(pairs, F.col("cell") == F.col("i")).withColumn("z", F.explode(F.sequence(F.lit(0), F.col("nj") - 1))).withColumnRenamed("salt", "s").withColumn("side", F.lit(0))
    two = planted.join(pairs, F.col("cell") == F.col("j")).withColumn("s", F.explode(F.sequence(F.lit(0), F.col("ni") - 1))).withColumnRenamed("salt", "z").withColumn("side", F.lit(1))
    one = one.where((F.col("i") < F.col("j")) | (F.col("s") <= F.col("z")))
    two = two.where((F.col("i") < F.col("j")) | (F.col("s") < F.col("z")))
    keep = ["reps", "counts", "vectors", "paths", "i", "s", "j", "z", "size", "side"]
    both = one.select(keep).unionByName(two.select(keep)).repartition(max(1, min(TASKS, sum(n * m for _, _, n, m in met))), "i", "s", "j", "z", "size")
    return both.groupBy("i", "s", "j", "z", "size").applyInArrow(lambda block: _pair(block, spreads), "rep long, n long, root long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors (vec_id, embedding)."""
    rows = pick(vectors, "vec_id", "embedding")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~odd & ~zero
    named = rows.select("vec_id", F.when(good, F.sha2(F.col("embedding").cast("string").cast("binary"), 256)).alias("digest"))
    reps = cut(
        rows.where(good)
        .groupBy(F.sha2(F.col("embedding").cast("string").cast("binary"), 256).alias("digest"))
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("rows"), F.any_value("embedding").alias("embedding"))
        .where(F.col("rep").isNotNull())
        .withColumn("size", F.size("embedding"))
    )
    found = cut(near_pairs(reps))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_class = reps.select("digest", "rep", "rows").join(counts, "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = of_class.select("digest", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    # vectors that link with nothing, whatever their number, stay out of the join
    alone = named.where(F.col("digest").isNull()).select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    joined = named.where(F.col("digest").isNotNull()).join(of_class, "digest", "left").select("vec_id", "n_links", "component_id").unionByName(alone)
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (sqrt(a.q) * sqrt(b.q)) >= 0.95
), n AS (
  SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x
), r AS (
  SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.vec_id
), m AS (
  SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept FROM embeddings e JOIN m USING (vec_id) LEFT JOIN n USING (vec_id)
"""
