"""Facets of a search: how many of all its works have which type, year and subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomograph.operators.search import hits
from nomograph.plans.requests import SearchRequest
from nomograph.session import dealt
from nomograph.sources.corpus import Corpus

#: A sketch of 2**LG_K registers: its relative standard error is about 0.8 / 2**(LG_K / 2), 1.3 % here.
LG_K = 12
ERROR = 0.8 / 2 ** (LG_K / 2)


def _works(corpus: Corpus, request: SearchRequest) -> DataFrame:
    """work_uri and pairs (facet, value) of each work of the search, each pair once. One shuffle by work: works with several types or subjects don't multiply each other's."""
    works, types = hits(corpus, request)
    there = F.col("work_uri").isNotNull()
    year = F.year("doc_date").cast("string")
    rows = works.select("work_uri", F.when(year.isNotNull(), "year").alias("facet"), year.alias("value"), F.lit(True).alias("hit"))
    for facet, part in {"type": types.select("work_uri", F.col("type_uri").alias("value")), "subject": corpus.repeated("work_subjects").select("work_uri", F.col("concept_uri").alias("value"))}.items():
        rows = rows.unionByName(part.where(there).select("work_uri", F.lit(facet).alias("facet"), "value", F.lit(None).cast("boolean").alias("hit")))
    pair = F.when(F.col("facet").isNotNull(), F.struct("facet", "value"))
    return dealt(rows, "work_uri").groupBy("work_uri").agg(F.bool_or("hit").alias("hit"), F.collect_set(pair).alias("pairs")).where("hit").select("work_uri", "pairs")


def facets(corpus: Corpus, request: SearchRequest) -> DataFrame:
    """facet, value, n_works (exact), sketch, n_about: works with each value, with any value of a facet (value null), and with any of any facet (both null).

    A work counts once for each of its pairs, for each of their facets and for all, so counts need no sets of works. Sketches merge: those of several searches, days or clusters are put
    together by merged() without their works."""
    none = F.lit(None).cast("string")
    of = lambda level, facet, value: F.struct(F.lit(level).alias("level"), facet.alias("facet"), value.alias("value"))
    values = F.transform("pairs", lambda p: of(2, p["facet"], p["value"]))
    kinds = F.transform(F.array_distinct(F.transform("pairs", lambda p: p["facet"])), lambda f: of(1, f, none))
    whole = F.when(F.size("pairs") > 0, F.array(of(0, none, none))).otherwise(F.array().cast("array<struct<level:int,facet:string,value:string>>"))
    each = _works(corpus, request).select("work_uri", F.explode(F.concat(values, kinds, whole)).alias("g")).select("work_uri", "g.*")
    counted = each.groupBy("level", "facet", "value").agg(F.count("work_uri").alias("n_works"), F.hll_sketch_agg("work_uri", LG_K).alias("sketch")).drop("level")
    return counted.withColumn("n_about", F.hll_sketch_estimate("sketch"))


def merged(facets: DataFrame) -> DataFrame:
    """facet, value, n_about of the union of several facets() results."""
    return facets.groupBy("facet", "value").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_about"))


def close(exact: Column, about: Column, deviations: float = 4) -> Column:
    """Whether an estimate is within so many standard errors."""
    return F.abs(about - exact) <= F.ceil(exact * ERROR * deviations)
