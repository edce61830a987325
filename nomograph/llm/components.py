"""Connected components by alternating large and small stars; every step is a shuffle by vertex, none gathers a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.llm.common import cut


def connected(edges: DataFrame) -> DataFrame:
    """edges: a, b. id and component_id (the least id reachable) of every id in edges; loops alone give no row.

    The minimum of each vertex's neighbours is aggregated before it is joined back, so a vertex with very many
    edges costs one row on that side, and the join's other side may be split."""
    now = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = cut(small.where(F.col("u") != F.col("v")).distinct())
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots.select("id", F.col("id").alias("component_id")))


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
