"""Mixing sources to target weights.

Every document gets a hash-random key. Keys are read as ranges (their leading hex digits); each source's
ranges are summed where the rows lie, prefix sums over the ranges find the one range in which the source's
budget ends, first of a few thousand wide ranges, then of those inside the one found, and only the last range's rows are
sorted to find the exact cut. So no source's rows, and no unbounded number of its ranges, ever meet in one task. A budget
above the source's size takes whole epochs first. Targets need one row for each source in one task.

Targets: all sizes times EXTRA, shared by weight; no target above MAX_EPOCHS times its source's size, the
excess reshared by weight. This has a closed form: with sources in order of (cap / weight), those before
the first whose share fits under its cap are full, and the others share the rest by weight.

Defined cases: a null text has size 0; null is a source of its own, after all others; rows that share a key
(repeated doc_ids) at the cut share what is left in proportion to their sizes; sources without words get
the target 0; an empty table gives an empty result. Reruns agree: keys depend on doc_id alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import cut, pick, table

WEIGHTS = (5, 2, 1)
EXTRA = 1.5
MAX_EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"
#: A key range holds about so many rows; how many there are follows from the number of rows.
RANGE_ROWS = 20_000
#: Digits by which the range of a cut is narrowed at a time.
DIGITS = 3
#: A table of sources is broadcast up to this many rows (each under a kilobyte); beyond it, joined by shuffle.
BROADCAST_SOURCES = 50_000


def _source(source: Column, doc_id: Column) -> list[Column]:
    """What mixing works on: the source, whether it is null, and the random key."""
    return [F.coalesce(source, F.lit("")).alias("_src"), source.isNull().alias("_none"), F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))).alias("_key")]


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sums: DataFrame) -> DataFrame:
    """sums: _src, _none, source_size. Adds weight and target. Its rows are as many as there are sources."""
    place = F.row_number().over(Window.orderBy("_none", "_src"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    by_ratio = Window.orderBy("_ratio", "_none", "_src")
    everything = Window.partitionBy()
    shares = (
        sums.withColumn("weight", weight)
        .withColumn("_ratio", F.lit(float(MAX_EPOCHS)) * F.col("source_size") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_full", F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_weights", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.lit(EXTRA) * F.col("_total") - F.lit(float(MAX_EPOCHS)) * F.coalesce("_full", F.lit(0))) / F.col("_weights"))
        .withColumn("_fits", F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_none", "_src", "_level")))
        .withColumn("_level", F.min("_fits").over(everything)["_level"])
    )
    cap = F.lit(float(MAX_EPOCHS)) * F.col("source_size")
    return shares.select("_src", "_none", "source_size", "weight", F.least(cap, F.col("weight") * F.coalesce("_level", F.lit(0.0))).alias("target"))


def cuts(sized: DataFrame) -> DataFrame:
    """sized: _src, _none, _key, size. A row for each source: source_size, target, epochs, and where the last epoch ends: keys before cut_key are in, rows with it take part in proportion (cut_part of cut_whole words)."""
    digits = max(0, math.ceil(math.log(max(1, sized.count()) / RANGE_ROWS, 16)))
    source = ["_src", "_none"]
    budget = (
        targets(sized.groupBy(*source).agg(F.sum("size").alias("source_size")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
        .withColumn("_rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    )
    budget = cut(budget)
    # the range in which a source's budget ends, narrowed by a few digits at a time; _within: what of the budget is left there
    ends = budget.where("_rest > 0").select(*source, F.lit("").alias("_range"), F.col("_rest").alias("_within"))
    steps = [*range(DIGITS, digits, DIGITS), digits]
    for width in steps:
        inside = sized.join(few(ends), source).where(F.startswith("_key", F.col("_range"))).select(*source, F.substring("_key", 1, width).alias("_range"), "_within", "size")
        ends = cut(_end(inside, "_range").select(*source, "_range", F.col("part").alias("_within")))
    inside = sized.join(few(ends), source).where(F.startswith("_key", F.col("_range"))).select(*source, "_key", "_within", "size")
    last = _end(inside, "_key").select(*source, F.col("_key").alias("cut_key"), F.col("part").alias("cut_part"), F.col("_words").alias("cut_whole"))
    return cut(budget.drop("_rest", "weight").join(last, source, "left"))


def _end(inside: DataFrame, by: str) -> DataFrame:
    """Of each source's ranges (or keys) in order the one at which their words reach _within, and the part of its words that is needed. A window holds 16 ** DIGITS ranges, or the keys of one range."""
    words = inside.groupBy("_src", "_none", by, "_within").agg(F.sum("size").alias("_words"))
    upto = F.sum("_words").over(Window.partitionBy("_src", "_none").orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    reached = words.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_within")) & (F.col("_upto") - F.col("_words") < F.col("_within")))
    return reached.withColumn("part", F.col("_within") - F.col("_upto") + F.col("_words"))


def few(sources: DataFrame) -> DataFrame:
    """A table with a row for each source: broadcast while it is small."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def words_taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every row."""
    rows = pick(docs, "doc_id", "source", "text")
    sized = cut(rows.select("doc_id", *_source(F.col("source"), F.col("doc_id")), _size(F.col("text")).alias("size")))
    part = F.when(F.col("_key") < F.col("cut_key"), F.col("size")).when(F.col("_key") == F.col("cut_key"), F.expr("size * cut_part div cut_whole")).otherwise(F.lit(0))
    return sized.join(few(cuts(sized)), ["_src", "_none"]).select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus with docs' columns: whole documents, each once per epoch that takes it. The document at
    a source's cut is in if at least half of it is within the budget, so a source misses its target by
    less than a document."""
    sized = cut(pick(docs, "doc_id", "source", "text").select(*_source(F.col("source"), F.col("doc_id")), _size(F.col("text")).alias("size")))
    last = F.coalesce((F.col("_key") < F.col("cut_key")) | ((F.col("_key") == F.col("cut_key")) & (2 * F.col("cut_part") >= F.col("cut_whole"))), F.lit(False))
    copies = F.col("epochs") + last.cast("long")
    row = F.col("_row")  # a document's own columns, whatever their names
    rows = docs.select(F.struct("*").alias("_row")).select("_row", *_source(row["source"], row["doc_id"]))
    joined = rows.join(few(cuts(sized)), ["_src", "_none"]).where(copies > 0)
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*[row[c].alias(c) for c in docs.columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS nul, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT src, nul, CAST(sum(size) AS BIGINT) AS ss, CASE (row_number() OVER (ORDER BY nul, src) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY src, nul
), r AS (
  SELECT *, 2.0::DOUBLE * ss / w AS ratio, row_number() OVER (ORDER BY 2.0::DOUBLE * ss / w, nul, src) AS p FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(ss) OVER () - 2.0::DOUBLE * coalesce(sum(ss) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r
), t AS (
  SELECT src, nul, ss, least(2.0::DOUBLE * ss, w * coalesce((SELECT lev FROM l WHERE lev <= ratio ORDER BY p LIMIT 1), 0)) AS target FROM l
), e AS (
  SELECT *, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS ep FROM t
), b AS (
  SELECT *, CAST(floor(target - ep * ss) AS BIGINT) AS rest FROM e
), g AS (
  SELECT src, nul, k, CAST(sum(size) AS BIGINT) AS gw FROM d GROUP BY src, nul, k
), c AS (
  SELECT *, CAST(sum(gw) OVER (PARTITION BY src, nul ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) - gw AS before FROM g
)
SELECT d.doc_id, d.size, b.ss AS source_size, b.target,
  CAST(ep * size + CASE WHEN gw = 0 THEN 0 ELSE size * greatest(0, least(gw, rest - before)) // gw END AS BIGINT) AS taken
FROM d JOIN b USING (src, nul) JOIN c USING (src, nul, k)
"""
