"""Near-duplicate documents by HyperMinHash.

A document's set: its distinct shingles of five words, lower-cased in A-Z. Each shingle's 64-bit hash falls into one of
128 buckets by its leading bits; a bucket keeps its least hash as a count of leading zeros and the ten bits
after the first one. Empty buckets borrow from a full one, chosen by a fixed order for each bucket. Four registers
make a band. Documents that share a band are candidates; the share of equal registers, corrected for
registers that agree by chance, estimates their Jaccard similarity; pairs not clearly below the threshold are
confirmed on the full sets.

Documents with equal sets form a class, and one stands for it. In a band's group, members are compared with
two hubs, its most connected member and one drawn by hash, and all with all only in groups of a few. Confirmed links give
components. What remains are groups whose members lie in different components. Their documents meet in blocks, each
document once whatever the number of bands it shares, and a task compares two blocks: only documents of different
components, and twice. First sketches alone travel, and documents whose sketch is like none of another component are
done with. Then the others meet with their full sets; a link found joins two components at once, so a task returns a link
for each join and not the pairs. No candidate is dropped.

Defined cases: null and blank texts have an empty set, 0 shingles and no links; texts of fewer than five words have
one shingle; repeated rows and exact copies link; an empty table gives an empty result; texts of any
length count whole; other columns are ignored by near_duplicates and passed through by keep_one_of_each.
doc_id identifies a document: rows that share it are the same document. A row without an id names no component, so that
its component_id is that of an equal text, or null, and its kept is null, as doc_id = component_id is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import checkpoint_dir, cut, no_table, pick, small_batches, table, utf8
from nomograph.llm.components import connected

WORDS = 5
PERCENT = 75
REGISTERS = 128
MANTISSA = 10
BAND = 4
#: Pairs whose estimate is lower than the threshold by over five standard deviations aren't confirmed.
MARGIN = 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
#: Chance that registers of disjoint sets agree: the same zeros (1/3) and the same mantissa.
CHANCE = 2.0**-MANTISSA / 3
#: Groups up to this size are compared all with all at once.
FEW = 5
#: Documents in a block of those that remain to compare.
BLOCK = 2048
#: Tables of ids are broadcast up to this many rows of a few bytes.
BROADCAST_IDS = 200_000

_BITS = REGISTERS.bit_length() - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.argsort(np.random.Generator(np.random.PCG64(1)).random((REGISTERS, REGISTERS)), axis=1)
_ORDER = np.concatenate([np.arange(REGISTERS)[:, None], _ORDER], axis=1)  # a full bucket keeps its own


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: bytes | None) -> np.ndarray:
    """The set's hashes, sorted."""
    import xxhash

    words = (text or b"").lower().split()  # bytes.lower() changes A-Z alone
    if not words:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        n = max(1, len(words) - WORDS + 1)
        width = min(WORDS, len(words))
        key = h[:n] + np.uint64(width)
        for k in range(1, width):
            key = _mixed(key) + h[k : k + n] * _MIX
        return np.unique(_mixed(key))


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers (int16) and the keys of the bands (int64) of a set that isn't empty."""
    with np.errstate(over="ignore"):
        bucket = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted: the first of a bucket is its least
        rest = (hashes[first] << np.uint64(_BITS)) | np.uint64(1)
        length = np.frexp(rest.astype(np.float64))[1].astype(np.uint64)  # bits up to the leading one
        over = (rest >> np.minimum(length - np.uint64(1), np.uint64(63))) == 0  # the conversion rounded up
        length -= over.astype(np.uint64)
        zeros = np.uint64(64) - length
        mantissa = (rest << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
        value = np.zeros(REGISTERS, np.uint64)
        value[bucket[first]] = (zeros << np.uint64(MANTISSA)) | mantissa
        full = np.zeros(REGISTERS, bool)
        full[bucket[first]] = True
        source = np.arange(REGISTERS) if full.all() else _ORDER[np.arange(REGISTERS), full[_ORDER].argmax(axis=1)]
        value = value[source]
        key = np.arange(REGISTERS // BAND, dtype=np.uint64) + np.uint64(1)
        for column in (value | (source.astype(np.uint64) << np.uint64(20))).reshape(-1, BAND).T:
            key = _mixed(key * _MIX + column)
    return value.astype(np.uint16).view(np.int16), key.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), registers and bands (null for sets of one or two, which only link with equal ones)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            sizes, digests, registers, bands = [], [], [], []
            for text in utf8(batch.column(1)):
                h = shingles(text)
                sizes.append(len(h))
                digests.append(hashlib.sha256(h.tobytes()).digest()[:20] if len(h) else None)
                r, b = sketch(h) if len(h) > 2 else (None, None)
                registers.append(r)
                bands.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(registers, pa.list_(pa.int16())), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "registers", "bands"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, registers array<smallint>, bands array<long>")


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and shingles (sorted array of long) of the documents whose id is in ids."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            sets = [shingles(x).view(np.int64) for x in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    return pick(docs, "doc_id", "text").join(few, "doc_id", "left_semi").mapInArrow(run, "doc_id long, shingles array<long>").dropDuplicates(["doc_id"])


def estimate(x: Column, y: Column) -> Column:
    """Jaccard similarity by two sketches, corrected for chance."""
    equal = F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, e: n + e)
    return (equal / F.lit(float(REGISTERS)) - F.lit(CHANCE)) / F.lit(1 - CHANCE)


def confirmed(docs: DataFrame, registers: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links among pairs (a < b, distinct): those that the sketches let pass and the full sets confirm. Not checkpointed: their components are."""
    pairs = cut(pairs)
    likely = cut(
        pairs.join(registers.select(F.col("doc_id").alias("a"), F.col("registers").alias("x")), "a")
        .join(registers.select(F.col("doc_id").alias("b"), F.col("registers").alias("y")), "b")
        .where(estimate(F.col("x"), F.col("y")) >= PERCENT / 100 - MARGIN)
        .select("a", "b")
    )
    sets = cut(sets_of(docs, cut(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())))
    both = F.size(F.array_intersect("x", "y"))
    return (
        likely.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .where(100 * both >= PERCENT * (F.size("x") + F.size("y") - both))
        .select("a", "b")
    )


def _rows(column: pa.ChunkedArray, kind: np.dtype) -> list[np.ndarray]:
    return [x.values.to_numpy().astype(kind, copy=False) for x in column]


#: So many equal registers may belong to a link.
_NEED = REGISTERS * (CHANCE + (1 - CHANCE) * (PERCENT / 100 - MARGIN))


def _sides(block: pa.Table) -> tuple[bool, pa.Table, pa.Table]:
    """Whether a block meets itself, and the two."""
    first, one = block["side"].to_numpy() == 0, block["i"][0].as_py() == block["j"][0].as_py()
    a = block.filter(pa.array(first))
    return one, a, a if one else block.filter(pa.array(~first))


def _alike(block: pa.Table) -> pa.Table:
    """The documents of two blocks, or of one, whose sketch is like one of another component."""
    one, a, b = _sides(block)
    parts, regs = [t["part"].to_numpy() for t in (a, b)], [np.stack(_rows(t["registers"], np.int16)) if len(t) else np.empty((0, REGISTERS), np.int16) for t in (a, b)]
    found = [np.zeros(len(t), bool) for t in (a, b)]
    if one:
        found[1] = found[0]
    for i in range(len(a)):
        far = np.flatnonzero(parts[1][i + 1 if one else 0 :] != parts[0][i]) + (i + 1 if one else 0)
        like = far[np.count_nonzero(regs[1][far] == regs[0][i], axis=1) >= _NEED]
        found[0][i] |= bool(len(like))
        found[1][like] = True
    ids = [t["doc_id"].to_numpy()[f] for t, f in zip((a, b), found, strict=True)]
    return pa.table({"doc_id": pa.array(ids[0] if one else np.concatenate(ids), pa.int64())})


def _compare(block: pa.Table) -> pa.Table:
    """Links between documents of two blocks, or of one, that lie in different components; one link joins two."""
    one, a, b = _sides(block)
    out: list[tuple[int, int]] = []
    if len(a) and len(b):
        ids, part = [t["doc_id"].to_numpy() for t in (a, b)], [t["part"].to_numpy().copy() for t in (a, b)]
        if one:
            part[1] = part[0]
        regs = [np.stack(_rows(t["registers"], np.int16)) for t in (a, b)]
        sets = [[x.view(np.uint64) for x in _rows(t["shingles"], np.int64)] for t in (a, b)]  # sorted as they were hashed
        for i in range(len(a)):
            far = np.flatnonzero(part[1][i + 1 if one else 0 :] != part[0][i]) + (i + 1 if one else 0)
            equal = np.count_nonzero(regs[1][far] == regs[0][i], axis=1)
            far, equal = far[equal >= _NEED], equal[equal >= _NEED]
            for j in far[np.argsort(-equal, kind="stable")]:
                x, y = sets[0][i], sets[1][j]
                if part[0][i] == part[1][j] or 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
                    continue
                n = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                if 100 * n >= PERCENT * (len(x) + len(y) - n):
                    out.append((int(ids[0][i]), int(ids[1][j])))
                    gone, stays = part[1][j], part[0][i]
                    for p in part[: 1 if one else 2]:
                        p[p == gone] = stays
    return pa.table({"a": pa.array([p for p, _ in out], pa.int64()), "b": pa.array([q for _, q in out], pa.int64())})


def _meeting(members: DataFrame) -> DataFrame:
    """members: doc_id, area and others. Each document once for every block of its area: area, i <= j, side, and the members' columns."""
    sizes = members.groupBy("area").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "area").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return each.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).drop("own", "other", "blocks")


def remaining(docs: DataFrame, registers: DataFrame, groups: DataFrame, parts: DataFrame) -> DataFrame | None:
    """Links that join components among the members of one group; None if every group lies in one component."""
    sides = groups.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component_id", "doc_id").alias("part"))
    open_keys = sides.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("doc_id").alias("least")).where(F.col("low") < F.col("high")).select("key", "least")
    sides = cut(sides.join(open_keys, "key"))
    if sides.isEmpty():
        return None
    # areas: members of a group belong together. An edge for each document, and one for each two of their ends that a group joins
    ends = cut(sides.groupBy("doc_id").agg(F.min("least").alias("end")))
    by_key = sides.select("key", "doc_id").join(ends, "doc_id").groupBy("key", "end").agg(F.count("*").alias("n"))
    lowest = by_key.groupBy("key").agg(F.min("end").alias("low"))
    edges = ends.select(F.col("doc_id").alias("a"), F.col("end").alias("b")).unionByName(by_key.join(lowest, "key").select(F.col("low").alias("a"), F.col("end").alias("b")).distinct())
    where = cut(connected(edges)).select(F.col("id").alias("doc_id"), F.col("component_id").alias("area"))
    members = cut(sides.select("doc_id", "part").distinct().join(where, "doc_id").join(registers, "doc_id"))
    alike = cut(_meeting(members).groupBy("area", "i", "j").applyInArrow(_alike, "doc_id long").distinct())
    if alike.isEmpty():
        return None
    few = cut(members.join(alike, "doc_id").join(sets_of(docs, alike), "doc_id"))
    return _meeting(few).groupBy("area", "i", "j").applyInArrow(_compare, "a long, b long").select(*_pairs(F.col("a"), F.col("b")))


def _pairs(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, rep) and, for each rep that links with another, its component."""
    all_rows = cut(sketches(docs))
    rows = all_rows.select("doc_id", "n_shingles", "digest")
    reps = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # empty sets, whatever their number, stay out of the join
    rows = rows.where(F.col("digest").isNotNull()).join(reps, "digest").select("doc_id", "n_shingles", "rep").unionByName(rows.where(F.col("digest").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("rep")))
    standing = all_rows.join(reps, "digest").where((F.col("doc_id") == F.col("rep")) & F.col("bands").isNotNull()).select("doc_id", "registers", "bands").dropDuplicates(["doc_id"])
    standing = cut(standing)
    registers = standing.select("doc_id", "registers")

    banded = standing.select("doc_id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    groups = cut(banded.join(shared, "key"))
    central = groups.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    hubs = groups.join(central, "doc_id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("id"))).alias("c"), F.min(F.struct(F.xxhash64("doc_id", "key").alias("h"), F.col("doc_id").alias("id"))).alias("r"))
    hubs = hubs.select("key", F.explode(F.array_distinct(F.array(-F.col("c.id"), F.col("r.id")))).alias("hub"))
    stars = groups.join(hubs, "key").where(F.col("hub") != F.col("doc_id")).select(*_pairs(F.col("hub"), F.col("doc_id")))
    small = groups.where(F.col("n") <= FEW).select("key", "doc_id")
    small = small.join(small.select("key", F.col("doc_id").alias("other")), "key").where(F.col("doc_id") < F.col("other")).select(F.col("doc_id").alias("a"), F.col("other").alias("b"))
    links = confirmed(docs, registers, stars.unionByName(small).distinct())
    parts = cut(connected(links))
    more = remaining(docs, registers, groups.where(F.col("n") > FEW), parts)
    if more is not None:
        more = cut(more)
        if not more.isEmpty():
            parts = cut(connected(parts.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(more)))
    return rows, parts


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs."""
    rows, parts = classes(docs)
    found = F.coalesce("component_id", "rep")
    return rows.join(parts.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", "n_shingles", found.alias("component_id"), (F.col("doc_id") == found).alias("kept"))


#: Ids beyond all others, for rows whose own id is null or names several texts: of these rows those of one id and text share one.
_BEYOND, _ROOM = 2**62, 2**61


def _named(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with _near_id, which names a document, and _several, whether rows may share it; whether any do."""
    shared = cut(pick(docs, "doc_id").groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_shared")))
    n = shared.count()
    if not n:
        return docs.withColumns({"_near_id": docs["`doc_id`"].cast("long"), "_several": F.lit(False)}), False
    some = lambda df: F.broadcast(df) if n <= BROADCAST_IDS else df
    text = F.xxhash64(docs["`text`"])
    rows = pick(docs, "doc_id", "text").join(some(shared), F.col("doc_id").eqNullSafe(F.col("_shared")), "left_semi")
    texts = cut(rows.groupBy(F.col("doc_id").alias("_shared")).agg((F.col("_shared").isNull() | (F.min(F.xxhash64("text")) < F.max(F.xxhash64("text")))).alias("_torn")))
    own = F.when(F.col("_torn"), F.lit(_BEYOND) + F.pmod(F.xxhash64(docs["`doc_id`"], text), F.lit(_ROOM))).otherwise(docs["`doc_id`"])
    named = docs.join(some(texts), docs["`doc_id`"].eqNullSafe(texts["_shared"]), "left").withColumns({"_near_id": own, "_several": F.col("_torn").isNotNull()}).drop("_shared", "_torn")
    return cut(named), True


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near duplicates: that of the least doc_id. Rows without an id, or with one that names
    several texts, count as documents of their own behind all others; of rows equal in id and text one stays. Ids that go are
    broadcast while they are few."""
    named, several = _named(docs)
    gone = cut(near_duplicates(named.select(named["_near_id"].alias("doc_id"), named["`text`"].alias("text"))).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    stays = named.join(gone, named["_near_id"] == gone["_gone"], "left_anti")
    if several:
        by = Window.partitionBy("_near_id").orderBy(F.xxhash64(F.to_json(F.struct(*[named[f"`{c}`"] for c in docs.columns]))))
        one = stays.where("_several").withColumn("_nth", F.row_number().over(by)).where("_nth = 1").drop("_nth")
        stays = stays.where("NOT _several").unionByName(one)
    return stays.drop("_near_id", "_several")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * both_ >= 75 * (nx.n + ny.n - both_)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT DISTINCT doc_id, doc_id AS c FROM d UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id
), m AS (
  SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
