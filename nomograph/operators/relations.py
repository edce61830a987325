"""One-hop relations between works, and the newest consolidated version of an act."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nomograph.functions import text
from nomograph.functions.dims import RELATIONS
from nomograph.plans.config import entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.paging import Page
from nomograph.plans.requests import CEILING, SNAPSHOT_CAP, RelationRequest
from nomograph.sources.corpus import Corpus

CONSOLIDATES = RELATIONS["consolidated_version"][0]


def _specs(corpus: Corpus, types: tuple[str, ...]) -> DataFrame:
    """An arm for each relation type and direction, in the order of the request: ten rows at most."""
    arms = [(n, t, RELATIONS[t][0], d) for n, t in enumerate(types) for d in ("outgoing", "incoming") if RELATIONS[t][1] in (d, "both")]
    return corpus.spark.createDataFrame(arms, "ordinal int, relation_type string, predicate string, direction string")


def relation_rows(corpus: Corpus, sources: DataFrame, types: tuple[str, ...] = tuple(RELATIONS)) -> DataFrame:
    """sources: source_uri, source_celex (null if unknown). Every valid relation row of each source, duplicates included.

    A consolidated version counts if it has a CELEX and, where the source's is known, one of the same act."""
    specs, edges = F.broadcast(_specs(corpus, types)), corpus["edges"]
    arms = []
    for direction, near, far in (("outgoing", "src_uri", "dst_uri"), ("incoming", "dst_uri", "src_uri")):
        # told as values, so that a table of several kinds of edges gives up those that aren't asked for before it is made
        asked = [F.col("predicate") == RELATIONS[t][0] for t in types if RELATIONS[t][1] in (direction, "both")]
        own = edges.where(reduce(or_, asked, F.lit(False))).join(specs.where(F.col("direction") == direction), "predicate")
        arms.append(own.join(sources, F.col(near) == F.col("source_uri")).select("source_uri", "source_celex", "ordinal", "relation_type", "direction", F.col(far).alias("related_work_uri")))
    works = corpus["works"].select(F.col("work_uri").alias("related_work_uri"), F.col("celex").alias("related_celex_number"), F.col("doc_date").alias("related_date"))
    rows = arms[0].unionByName(arms[1]).join(works, "related_work_uri", "left")
    core = text.act_core(F.col("source_celex"))
    genuine = text.is_consolidated(F.col("related_celex_number")) & (text.act_core(F.col("related_celex_number")) == core)
    valid = F.when(F.col("relation_type") != "consolidated_version", True).when(F.col("related_celex_number").isNull(), False).when(core.isNull(), True).otherwise(genuine)
    return rows.where(valid)


def relations_of(corpus: Corpus, sources: DataFrame, types: tuple[str, ...] = tuple(RELATIONS), offset: int = 0, limit: int = CEILING) -> DataFrame:
    """Each arm's own page of rows, newest first, undated last, then by URI; an arm never takes another's room. place tells a row's position.

    The filter on the row number prunes each task's rows of an arm to the page before they are shuffled."""
    arm = Window.partitionBy("source_uri", "relation_type", "direction").orderBy(F.col("related_date").desc_nulls_last(), "related_work_uri")
    numbered = relation_rows(corpus, sources, types).withColumn("place", F.row_number().over(arm))
    return numbered.where((F.col("place") <= offset + limit) & (F.col("place") > offset))


def distinct_relations(rows: DataFrame) -> DataFrame:
    """The rows without repetitions of a work in one arm."""
    return rows.dropDuplicates(["source_uri", "relation_type", "direction", "related_work_uri"])


def truncation(rows: DataFrame, limit: int) -> DataFrame:
    """For each source whether an arm's page is full, counted after the validity filter and before repetitions go."""
    arms = rows.groupBy("source_uri", "relation_type", "direction").agg(F.count("*").alias("n"))
    return arms.groupBy("source_uri").agg(F.bool_or(F.col("n") >= limit).alias("truncated"), F.sum("n").alias("rows"))


def empty_types(corpus: Corpus, sources: DataFrame, rows: DataFrame, types: tuple[str, ...] = tuple(RELATIONS)) -> DataFrame:
    """The requested relation types without a row, for each source."""
    asked = sources.select("source_uri").join(F.broadcast(_specs(corpus, types).select("ordinal", "relation_type").distinct()))
    return asked.join(rows.select("source_uri", "relation_type").distinct(), ["source_uri", "relation_type"], "left_anti")


def latest_consolidated(corpus: Corpus, sources: DataFrame) -> DataFrame:
    """sources: source_uri, source_celex. The newest consolidated version of each act that has one, and its date. A source that is itself consolidated has none."""
    base = sources.where(F.col("source_celex").isNotNull() & ~text.is_consolidated(F.col("source_celex")))
    rows = relation_rows(corpus, base, ("consolidated_version",))
    newest = rows.groupBy("source_uri", "source_celex").agg(F.max(F.struct("related_celex_number", "related_work_uri")).alias("v"))
    return newest.select("source_uri", "source_celex", F.col("v.related_celex_number").alias("current_celex"), text.consolidation_date(F.col("v.related_celex_number")).alias("as_of"))


def source_of(corpus: Corpus, celex: str | None, work_uri: str | None) -> DataFrame:
    """The source work as a table of a row: by CELEX the work of the least URI."""
    if work_uri:
        return corpus.spark.createDataFrame([(work_uri, None)], "source_uri string, source_celex string")
    return corpus["works"].where(F.col("celex") == celex).groupBy(F.col("celex").alias("source_celex")).agg(F.min("work_uri").alias("source_uri")).select("source_uri", "source_celex")


@entry_point("find_relations")
def find_relations(corpus: Corpus, **arguments: object) -> tuple[Page, list[str]]:
    """The eager form: a page and the requested types without rows; raises not_found or no_relations."""
    request = RelationRequest(**arguments)
    source = source_of(corpus, request.celex, request.work_uri)
    if source.isEmpty():
        raise RequestError("not_found", f"No work has the CELEX {request.celex}.")
    request.limit = min(request.limit, corpus.settings.row_ceiling)
    rows = relations_of(corpus, source, request.types, request.offset, request.limit).orderBy("ordinal", F.desc("direction"), "place").collect()
    if not rows:
        raise RequestError("no_relations", "The work has no such relations.")
    arms, seen, kept = {}, set(), []
    for r in rows:
        arms[r.relation_type, r.direction] = arms.get((r.relation_type, r.direction), 0) + 1
        if (key := (r.relation_type, r.direction, r.related_work_uri)) not in seen:
            seen.add(key)
            kept.append(r)
    present = {r.relation_type for r in kept}
    return Page(kept, request.offset, any(n >= request.limit for n in arms.values()), request.limit, request.echo()), [t for t in request.types if t not in present]


def sources_of(corpus: Corpus, celexes: DataFrame) -> DataFrame:
    """celexes: celex. The source work of each that there is: the one of the least URI."""
    works = corpus["works"].join(celexes.distinct(), "celex", "left_semi")
    return works.groupBy(F.col("celex").alias("source_celex")).agg(F.min("work_uri").alias("source_uri")).select("source_uri", "source_celex")


def snapshots(corpus: Corpus, celexes: DataFrame) -> DataFrame:
    """celexes: celex. All relations of each work, a few of each arm."""
    return distinct_relations(relations_of(corpus, sources_of(corpus, celexes), limit=SNAPSHOT_CAP))


def snapshot(corpus: Corpus, celex: str) -> DataFrame:
    """All relations of a work, a few of each arm; an empty table is a result, not a failure."""
    return snapshots(corpus, corpus.spark.createDataFrame([(celex,)], "celex string"))
