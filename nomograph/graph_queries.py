"""Queries over many hops and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.functions import dims, text
from nomograph.operators import graph, temporal
from nomograph.queries import _CORE, query
from nomograph.sources.corpus import Corpus, with_tables

_HOPS = 6


_TYPES = ("cites", "amends", "repeals", "legal_basis")
_PREDICATES = ", ".join(f"'{dims.RELATIONS[t][0]}'" for t in _TYPES)


@query(
    "relations_closure",
    with_tables("works", "edges").replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", r AS (SELECT work_uri AS source, work_uri AS reached, 0 AS hops FROM works WHERE celex LIKE '6%'
  UNION SELECT r.source, e.dst_uri, r.hops + 1 FROM r JOIN edges e ON e.src_uri = r.reached WHERE e.predicate IN ({_PREDICATES}) AND r.hops < {_HOPS})
SELECT source, reached, min(hops) AS hops FROM r WHERE reached <> source GROUP BY source, reached""",
)
def _(c: Corpus) -> DataFrame:
    """All that each case relates to, directly or over up to six works."""
    return graph.relations_closure(c, c["works"].where(F.startswith("celex", F.lit("6"))).select(F.col("work_uri").alias("source")), _TYPES, _HOPS)


@query(
    "concept_rollup",
    with_tables("concepts", "concept_broader", "work_subjects").replace("WITH ", "WITH RECURSIVE ", 1)
    + """, up AS (SELECT DISTINCT concept_uri, concept_uri AS ancestor FROM work_subjects UNION SELECT up.concept_uri, b.broader_uri FROM up JOIN concept_broader b ON b.concept_uri = up.ancestor),
n AS (SELECT ancestor, count(DISTINCT work_uri) AS n FROM work_subjects JOIN up USING (concept_uri) GROUP BY ancestor),
d AS (SELECT concept_uri, count(DISTINCT work_uri) AS n FROM work_subjects GROUP BY concept_uri)
SELECT c.concept_uri, coalesce(d.n, 0) AS n_direct, coalesce(n.n, 0) AS n_works FROM (SELECT DISTINCT concept_uri FROM concepts) c LEFT JOIN d USING (concept_uri) LEFT JOIN n ON n.ancestor = c.concept_uri""",
)
def _(c: Corpus) -> DataFrame:
    return graph.rolled_up(c)


_VERSIONS = f"""v AS (SELECT act, from_date, max(celex) AS version FROM (SELECT celex, {_CORE.format("celex")} AS act, CAST(strptime(right(celex, 8), '%Y%m%d') AS DATE) AS from_date
  FROM works WHERE regexp_full_match(celex, '0[0-9]{{4}}[A-Z]{{1,2}}[0-9]+-[0-9]{{8}}')) GROUP BY act, from_date)"""


@query(
    "version_as_of",
    with_tables("works", "edges")
    + f""", {_VERSIONS}, r AS (SELECT DISTINCT c.work_uri AS case_uri, a.work_uri AS act_uri, {_CORE.format("a.celex")} AS act, c.doc_date AS date
  FROM edges JOIN works c ON c.work_uri = src_uri JOIN works a ON a.work_uri = dst_uri WHERE c.celex LIKE '6%' AND a.celex LIKE '3%')
SELECT r.*, v.version, v.from_date FROM r ASOF LEFT JOIN v ON v.act = r.act AND v.from_date <= r.date""",
)
def _(c: Corpus) -> DataFrame:
    """For every case and act that it relates to, the act's consolidated version on the day of the case."""
    works = c["works"].select("work_uri", "celex", "doc_date")
    cases = works.where(F.startswith("celex", F.lit("6"))).select(F.col("work_uri").alias("case_uri"), F.col("doc_date").alias("date"))
    acts = works.where(F.startswith("celex", F.lit("3"))).select(F.col("work_uri").alias("act_uri"), text.act_core(F.col("celex")).alias("act"))
    met = c["edges"].select(F.col("src_uri").alias("case_uri"), F.col("dst_uri").alias("act_uri")).distinct().join(cases, "case_uri").join(acts, "act_uri")
    return temporal.as_of(met.select("case_uri", "act_uri", "act", "date"), temporal.versions(c))


@query(
    "cases_while_in_force",
    with_tables("works")
    + f""", {_VERSIONS}, i AS (SELECT version, from_date, lead(from_date) OVER (PARTITION BY act ORDER BY from_date) AS to_date FROM v),
k AS (SELECT doc_date AS date, count(*) AS n FROM works WHERE celex LIKE '6%' AND doc_date IS NOT NULL GROUP BY doc_date)
SELECT version, from_date, to_date, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_cases, count(date) AS n_days FROM i LEFT JOIN k ON date >= from_date AND (to_date IS NULL OR date < to_date) GROUP BY version, from_date, to_date""",
)
def _(c: Corpus) -> DataFrame:
    return temporal.cases_while_in_force(c)
