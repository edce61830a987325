"""The engine's queries over a folder of carrier tables, and the SQL that states the result of each independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.functions import dims, text
from nomograph.operators import adhoc, content, document, identify, markdown, relations, render, search, structure, subjects
from nomograph.plans.requests import CaseRequest, SearchRequest, SubjectRequest
from nomograph.sources.corpus import Corpus, with_tables
from nomograph.streaming.windows import event_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Corpus], DataFrame]], Callable[[Corpus], DataFrame]]:
    """Registers a query over the corpus, with the SQL of its result."""

    def register(f: Callable[[Corpus], DataFrame]) -> Callable[[Corpus], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Corpus(spark, folder))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


# --- SQL building blocks, written for the checking engine only ---


def _values(labels: dict[str, str], namespace: str, name: str) -> str:
    rows = ", ".join("('" + namespace + k + "', '" + v.replace("'", "''") + "')" for k, v in labels.items())
    return f"{name}(uri, label) AS (VALUES {rows})"


_TYPES = _values(dims.TYPE_LABELS, dims.TYPE, "type_names")
_BODIES = _values(dims.BODY_LABELS, dims.BODY, "body_names")
_NORM = "lower(trim(regexp_replace(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}\\s]+', ' ', 'g'), '\\s+', ' ', 'g')))"


# White space of any kind at a text's ends.
_BLANK = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _strip(value: str) -> str:
    return f"regexp_replace(regexp_replace({value}, '^{_BLANK}+', ''), '{_BLANK}+$', '')"


def _phrase(column: str, wanted: str) -> str:
    return f"contains(' ' || {_NORM.format(column)} || ' ', ' ' || {_NORM.format(repr(wanted))} || ' ')"


def _page(where: str, types: str, limit: int, offset: int, select: str = "", more: str = "") -> str:
    """SQL of a page of works that pass where (over w), with the types among types (over t)."""
    tables = with_tables("works", "work_types", "expressions", "work_subjects", "work_agents", "agent_labels")
    return f"""{tables}, {_TYPES}{more},
hits AS (SELECT w.* FROM works w WHERE w.celex IS NOT NULL AND {where}),
k AS (SELECT celex, min(doc_date) AS date FROM hits GROUP BY celex ORDER BY date DESC NULLS LAST, celex LIMIT {limit} OFFSET {offset}),
tit AS (SELECT work_uri, title FROM expressions WHERE language_uri = '{dims.ENGLISH}'),
rows_ AS (
  SELECT h.celex, k.date, min(h.work_uri) AS any_work, max(CASE WHEN tit.title IS NOT NULL THEN h.work_uri END) AS titled, max(tit.title) AS title
  FROM hits h JOIN k USING (celex) LEFT JOIN tit USING (work_uri) GROUP BY h.celex, k.date),
names AS (SELECT DISTINCT h.celex, coalesce(n.label, list_extract(string_split(t.type_uri, '/'), -1)) AS label
  FROM hits h JOIN work_types t USING (work_uri) LEFT JOIN type_names n ON n.uri = t.type_uri WHERE {types}),
lab AS (SELECT celex, string_agg(label, ', ' ORDER BY label) AS resource_type FROM names GROUP BY celex)
SELECT coalesce(titled, any_work, '') AS work_uri, celex AS celex_number, {select or "regexp_full_match(celex, '0[0-9]{4}[A-Z]{1,2}[0-9]+-[0-9]{8}') AS is_consolidated,"} resource_type, date, title
FROM rows_ LEFT JOIN lab USING (celex)"""


# --- document search ---


def _type(*codes: str) -> str:
    return "t.type_uri IN (" + ", ".join(f"'{dims.TYPE}{c}'" for c in codes) + ")"


def _has_type(*codes: str) -> str:
    return f"EXISTS (SELECT 1 FROM work_types t WHERE t.work_uri = w.work_uri AND {_type(*codes)})"


@query("search_page", _page(f"w.doc_date >= DATE '1994-01-01' AND w.doc_date <= DATE '1997-12-31' AND {_has_type('REG')}", _type("REG"), 50, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(document_type="REG", date_from="1994-01-01", date_to="1997-12-31", limit=50))


@query("search_in_force_offset", _page("w.in_force", "true", 100, 40))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(in_force=True, offset=40, limit=100))


@query("search_type_or_consolidated", _page(_has_type("DIR", "CONS_TEXT"), _type("DIR", "CONS_TEXT"), 100, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(document_type="DIR", include_consolidated=True, limit=100))


_KEYWORD = f"""(w.work_uri IN (SELECT work_uri FROM expressions WHERE language_uri = '{dims.ENGLISH}' AND {_phrase("title", "part 7")})
  OR w.work_uri IN (SELECT work_uri FROM works WHERE contains(lower(celex), 'part 7')))"""


@query("search_keyword_union", _page(_KEYWORD.replace("part 7", "r000"), "true", 100, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(keyword="R000", limit=100))


@query("search_title_phrase", _page(_KEYWORD.replace("part 7", "judgment of the court"), "true", 100, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(keyword="judgment of: the COURT", limit=100))


@query("search_subject_semi", _page(f"w.work_uri IN (SELECT work_uri FROM work_subjects WHERE concept_uri = '{dims.CONCEPT}7')", "true", 100, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(concept=dims.CONCEPT + "7", limit=100))


@query("search_agent_semi", _page(f"w.work_uri IN (SELECT work_uri FROM work_agents JOIN agent_labels USING (agent_uri) WHERE lang = 'en' AND {_phrase('label', 'nation 1')})", "true", 100, 0))
def _(c: Corpus) -> DataFrame:
    return search.search_documents(c, SearchRequest(author="Nation_1", limit=100))


_ALL = f"""w.in_force AND w.doc_date >= DATE '1992-01-01' AND w.doc_date <= DATE '1998-12-31' AND {_has_type('REG', 'CONS_TEXT')}
  AND w.work_uri IN (SELECT work_uri FROM work_agents JOIN agent_labels USING (agent_uri) WHERE lang = 'en' AND {_phrase('label', 'supplier')})
  AND w.work_uri IN (SELECT work_uri FROM work_subjects WHERE concept_uri = '{dims.CONCEPT}45')
  AND {_KEYWORD.replace("part 7", "5")}"""


@query("search_all_filters", _page(_ALL, _type("REG", "CONS_TEXT"), 60, 0))
def _(c: Corpus) -> DataFrame:
    """Every filter of a request at once, over all works."""
    return search.search_documents(c, SearchRequest(keyword="5", document_type="REG", include_consolidated=True, date_from="1992-01-01", date_to="1998-12-31", concept=dims.CONCEPT + "45", author="supplier", in_force=True, limit=60))


# --- cases ---

_PARTS = rf"""SELECT f.*, CASE WHEN contains(title, '#') THEN coalesce(nullif(s[2], ''), nullif(s[1], '')) END AS display_title,
  CASE WHEN contains(title, '#') THEN nullif(s[2], '') END AS parties,
  CASE WHEN contains(title, '#') AND sub >= 3 THEN nullif(s[sub], '') END AS subject_matter,
  CASE WHEN ref THEN s[last_] END AS case_reference
FROM (SELECT *, CASE WHEN ref THEN last_ - 1 ELSE last_ END AS sub FROM (
  SELECT *, contains(title, '#') AND last_ >= 3 AND regexp_matches(s[last_], '^(?i)cases?\b') AS ref FROM (
    SELECT *, list_max(list_transform(range(1, len(s) + 1), lambda i: CASE WHEN s[i] <> '' THEN i ELSE 0 END)) AS last_ FROM (
      SELECT *, list_transform(string_split(title, '#'), lambda x: {_strip('x')}) AS s FROM found)))) f"""


def _cases(where: str, limit: int, parts: bool = True) -> str:
    inner = _page(f"w.celex LIKE '6%' AND {where}", "true", limit, 0, " ")
    cut = inner.rindex("\nSELECT coalesce(titled")
    sql = inner[:cut] + f", found AS ({inner[cut:]}) " + _PARTS
    return sql.replace("SELECT f.*,", "SELECT work_uri, celex_number, resource_type, date, title,")


_NOT_DERIVED = "NOT EXISTS (SELECT 1 FROM work_types t WHERE t.work_uri = w.work_uri AND t.type_uri IN (" + ", ".join(f"'{dims.TYPE}{t}'" for t in dims.DERIVATIVE_TYPES) + "))"


@query("cases_default_antijoin", _cases(_NOT_DERIVED, 100))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(limit=100))


@query("cases_court_dates", _cases(f"{_NOT_DERIVED} AND (contains(w.celex, 'TJ') OR contains(w.celex, 'TO')) AND w.doc_date <= DATE '1996-06-30'", 80))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(court="GC", date_to="1996-06-30", limit=80))


@query("cases_by_type_semi", _cases(_has_type("JUDG"), 100))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(case_type="judgment", limit=100))


@query("cases_by_number", _cases("contains(w.celex, '1995CJ00')", 100).replace("1995CJ00", "CJ0"))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(case_number="cj0", include_derivative=True, limit=100))


@query("cases_by_case_number", _cases(f"{_NOT_DERIVED} AND contains(w.celex, '1995CJ0794')", 100))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(case_number=" c-794/95", limit=100))


@query("cases_court_cjeu", _cases(f"{_NOT_DERIVED} AND (contains(w.celex, 'CJ') OR contains(w.celex, 'CC') OR contains(w.celex, 'CO')) AND w.doc_date >= DATE '1997-01-01'", 90))
def _(c: Corpus) -> DataFrame:
    return search.search_cases(c, CaseRequest(court="CJEU", date_from="1997-01-01", limit=90))


@query(
    "case_number_fragment",
    with_tables("works")
    + """ SELECT celex, substr(celex, 6, 1) || '-' || ltrim(substr(celex, 8), '0') || '/' || substr(celex, 4, 2) AS number,
  CASE WHEN substr(celex, 6, 1) IN ('C', 'T') AND length(ltrim(substr(celex, 8), '0')) > 0 THEN (CASE WHEN substr(celex, 4, 2) <= '60' THEN '20' ELSE '19' END) || substr(celex, 4, 2) || substr(celex, 6, 1) || 'J'
    || CASE WHEN length(ltrim(substr(celex, 8), '0')) < 4 THEN lpad(ltrim(substr(celex, 8), '0'), 4, '0') ELSE ltrim(substr(celex, 8), '0') END END AS fragment
FROM works WHERE celex LIKE '6%'""",
)
def _(c: Corpus) -> DataFrame:
    cases = c["works"].where(F.startswith("celex", F.lit("6"))).select("celex", F.concat(F.substring("celex", 6, 1), F.lit("-"), F.ltrim(F.substring("celex", 8, 20), F.lit("0")), F.lit("/"), F.substring("celex", 4, 2)).alias("number"))
    return cases.select("celex", "number", text.case_fragment(F.col("number")).alias("fragment"))


@query("cases_title_parse", with_tables("expressions") + ", found AS (SELECT expr_uri, title FROM expressions) " + _PARTS.replace("SELECT f.*,", "SELECT expr_uri,"))
def _(c: Corpus) -> DataFrame:
    return c["expressions"].select("expr_uri", text.case_title(F.col("title")).alias("t")).select("expr_uri", "t.display_title", "t.parties", "t.subject_matter", "t.case_reference")


# --- identifiers ---

_LOOKUP = """, best AS (SELECT * FROM (SELECT x.identifier, x.priority, w.work_uri, w.celex, w.doc_date, row_number() OVER (PARTITION BY x.identifier ORDER BY x.priority, w.work_uri) AS n
  FROM tries x JOIN works w ON {on} WHERE w.celex IS NOT NULL) WHERE n = 1)
SELECT i.identifier, b.work_uri IS NOT NULL AS found, b.work_uri, b.celex AS celex_number, (SELECT min(type_uri) FROM work_types t WHERE t.work_uri = b.work_uri) AS resource_type, b.doc_date AS date
FROM ids i LEFT JOIN best b USING (identifier)"""


@query("lookup_celex", with_tables("works", "work_types") + ", ids AS (SELECT DISTINCT '3' || substr(celex, 2) AS identifier FROM works WHERE celex IS NOT NULL), tries AS (SELECT identifier, 0 AS priority FROM ids)" + _LOOKUP.format(on="w.celex = x.identifier"))
def _(c: Corpus) -> DataFrame:
    ids = c["works"].where(F.col("celex").isNotNull()).select(F.concat(F.lit("3"), F.substring("celex", 2, 40)).alias("identifier")).distinct()
    return identify.resolve(c, ids.withColumn("kind", F.lit("celex")))


_ELI = f""", ids AS (SELECT DISTINCT regexp_replace(eli, '/oj$', '') AS identifier FROM works WHERE eli IS NOT NULL),
tries AS (SELECT identifier, identifier AS value, 0 AS priority FROM ids UNION ALL SELECT identifier, identifier || '/oj', 1 FROM ids WHERE regexp_matches(identifier, '^{dims.ELI}[^/]+/[0-9]{{4}}/[^/]+$'))"""


@query("lookup_eli_fallback", with_tables("works", "work_types") + _ELI + _LOOKUP.format(on="w.eli = x.value"))
def _(c: Corpus) -> DataFrame:
    ids = c["works"].where(F.col("eli").isNotNull()).select(F.regexp_replace("eli", "/oj$", "").alias("identifier")).distinct()
    return identify.resolve(c, ids.withColumn("kind", F.lit("eli")))


@query(
    "identifier_kinds",
    with_tables("works")
    + f""", ids AS (SELECT celex AS identifier FROM works WHERE celex IS NOT NULL UNION ALL SELECT eli FROM works WHERE eli IS NOT NULL UNION ALL SELECT work_uri FROM works)
SELECT identifier, CASE WHEN regexp_matches(identifier, '^[1-9][0-9]{{4}}[A-Z]+[0-9]+') THEN 'celex' WHEN starts_with(identifier, '{dims.ELI}') THEN 'eli' END AS kind,
  nullif(regexp_extract(identifier, '^[0-9A-Z]([0-9]{{4}}[A-Z]{{1,2}}[0-9]+)', 1), '') AS act_core, regexp_full_match(identifier, '0[0-9]{{4}}[A-Z]{{1,2}}[0-9]+-[0-9]{{8}}') AS consolidated,
  CASE WHEN regexp_full_match(identifier, '0[0-9]{{4}}[A-Z]{{1,2}}[0-9]+-[0-9]{{8}}') THEN regexp_replace(identifier, '^.*-([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})$', '\\1-\\2-\\3') END AS as_of FROM ids""",
)
def _(c: Corpus) -> DataFrame:
    w, i = c["works"], F.col("identifier")
    ids = w.where(F.col("celex").isNotNull()).select(F.col("celex").alias("identifier")).union(w.where(F.col("eli").isNotNull()).select("eli")).union(w.select("work_uri"))
    return ids.select("identifier", text.identifier_kind(i).alias("kind"), text.act_core(i).alias("act_core"), text.is_consolidated(i).alias("consolidated"), text.consolidation_date(i).alias("as_of"))


# --- thesaurus ---


@query(
    "subjects_page",
    with_tables("concepts", "concept_labels", "concept_notations", "concept_broader")
    + f""", l AS (SELECT concept_uri, label FROM concept_labels WHERE lang = 'en')
SELECT l.concept_uri, l.label AS pref_label, (SELECT min(notation) FROM concept_notations n WHERE n.concept_uri = l.concept_uri) AS concept_code,
  (SELECT min(b.label) FROM concept_broader x JOIN l b ON b.concept_uri = x.broader_uri WHERE x.concept_uri = l.concept_uri) AS broader_label
FROM l WHERE starts_with(concept_uri, '{dims.CONCEPT}') AND contains(lower(label), 'ring') AND concept_uri IN (SELECT concept_uri FROM concepts)
ORDER BY label, concept_uri LIMIT 50 OFFSET 10""",
)
def _(c: Corpus) -> DataFrame:
    return subjects.search_subjects(c, SubjectRequest(keyword="RING", offset=10, limit=50))


# --- relations ---


def _sources(c: Corpus) -> DataFrame:
    return c["works"].where(~F.startswith("work_uri", F.lit("http://works.example/c"))).select(F.col("work_uri").alias("source_uri"), F.col("celex").alias("source_celex"))


_SPECS = "specs(ordinal, relation_type, predicate, direction) AS (VALUES " + ", ".join(f"({n}, '{t}', '{p}', '{d}')" for n, (t, (p, w)) in enumerate(dims.RELATIONS.items()) for d in ("outgoing", "incoming") if w in (d, "both")) + ")"
_CORE = r"nullif(regexp_extract({0}, '^[0-9A-Z]([0-9]{{4}}[A-Z]{{1,2}}[0-9]+)', 1), '')"
_ROWS = (
    with_tables("works", "edges")
    + f""", {_SPECS}, src AS (SELECT work_uri AS source_uri, celex AS source_celex FROM works WHERE NOT starts_with(work_uri, 'http://works.example/c')),
raw AS (SELECT e.src_uri AS source_uri, s.*, e.dst_uri AS related FROM edges e JOIN specs s USING (predicate) WHERE s.direction = 'outgoing'
  UNION ALL SELECT e.dst_uri, s.*, e.src_uri FROM edges e JOIN specs s USING (predicate) WHERE s.direction = 'incoming'),
rel AS (SELECT r.source_uri, r.ordinal, r.relation_type, r.direction, r.related, w.celex AS related_celex, w.doc_date AS related_date, src.source_celex
  FROM raw r JOIN src USING (source_uri) LEFT JOIN works w ON w.work_uri = r.related
  WHERE r.relation_type <> 'consolidated_version' OR (w.celex IS NOT NULL AND ({_CORE.format("src.source_celex")} IS NULL OR
    (regexp_full_match(w.celex, '0[0-9]{{4}}[A-Z]{{1,2}}[0-9]+-[0-9]{{8}}') AND {_CORE.format("w.celex")} = {_CORE.format("src.source_celex")}))))"""
)


@query(
    "relations_topk_per_arm",
    _ROWS
    + """ SELECT source_uri, relation_type, direction, related AS related_work_uri, related_celex AS related_celex_number, n AS place FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY source_uri, relation_type, direction ORDER BY related_date DESC NULLS LAST, related) AS INTEGER) AS n FROM rel) WHERE n > 1 AND n <= 3""",
)
def _(c: Corpus) -> DataFrame:
    return relations.relations_of(c, _sources(c), offset=1, limit=2).select("source_uri", "relation_type", "direction", "related_work_uri", "related_celex_number", "place")


@query("relations_union_both", _ROWS + " SELECT source_uri, direction, related AS related_work_uri, related_celex AS related_celex_number FROM rel WHERE relation_type = 'cites'")
def _(c: Corpus) -> DataFrame:
    return relations.relation_rows(c, _sources(c), ("cites",)).select("source_uri", "direction", "related_work_uri", "related_celex_number")


@query("relations_truncation_flags", _ROWS + """ SELECT source_uri, bool_or(n >= 2) AS truncated, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT source_uri, relation_type, direction, least(count(*), 2) AS n FROM rel GROUP BY ALL) GROUP BY source_uri""")
def _(c: Corpus) -> DataFrame:
    return relations.truncation(relations.relations_of(c, _sources(c), limit=2), 2)


@query("relations_empty_types", _ROWS + " SELECT source_uri, relation_type, CAST(ordinal AS INTEGER) AS ordinal FROM (SELECT DISTINCT source_uri, relation_type, ordinal FROM src, specs) WHERE (source_uri, relation_type) NOT IN (SELECT source_uri, relation_type FROM rel)")
def _(c: Corpus) -> DataFrame:
    return relations.empty_types(c, _sources(c), relations.relation_rows(c, _sources(c)))


@query("latest_consolidated", _ROWS + r""" SELECT source_uri, source_celex, max(related_celex) AS current_celex, regexp_replace(max(related_celex), '^.*-([0-9]{4})([0-9]{2})([0-9]{2})$', '\1-\2-\3') AS as_of
FROM rel WHERE relation_type = 'consolidated_version' AND source_celex IS NOT NULL GROUP BY source_uri, source_celex""")
def _(c: Corpus) -> DataFrame:
    return relations.latest_consolidated(c, _sources(c))


@query("relations_snapshot", _ROWS + """ SELECT DISTINCT relation_type, direction, related AS related_work_uri, related_celex AS related_celex_number FROM (
  SELECT *, row_number() OVER (PARTITION BY source_uri, relation_type, direction ORDER BY related_date DESC NULLS LAST, related) AS n FROM rel
  WHERE source_uri = (SELECT min(work_uri) FROM works WHERE celex = (SELECT min(celex) FROM works JOIN edges ON src_uri = work_uri WHERE celex LIKE '3%'))) WHERE n <= 25""")
def _(c: Corpus) -> DataFrame:
    citing = c["works"].join(c["edges"], F.col("work_uri") == F.col("src_uri"), "left_semi")
    least = citing.where(F.startswith("celex", F.lit("3"))).agg(F.min("celex").alias("celex"))
    return relations.snapshots(c, least).select("relation_type", "direction", "related_work_uri", "related_celex_number")


@query("relations_text", _ROWS + """, paged AS (SELECT *, row_number() OVER (PARTITION BY source_uri, relation_type, direction ORDER BY related_date DESC NULLS LAST, related) AS n FROM rel),
arms AS (SELECT source_uri, ordinal, direction, '### ' || relation_type || ' (' || direction || ')' || chr(10) || string_agg('- ' || CASE WHEN related_celex IS NULL THEN related ELSE related_celex || ' (' || related || ')' END, chr(10) ORDER BY n) AS block
  FROM paged WHERE n <= 3 GROUP BY source_uri, ordinal, relation_type, direction)
SELECT source_uri, string_agg(block, chr(10) || chr(10) ORDER BY ordinal, direction DESC) AS text FROM arms GROUP BY source_uri""")
def _(c: Corpus) -> DataFrame:
    return render.relations_text(relations.relations_of(c, _sources(c), limit=3))


# --- documents ---

_META = f"""{with_tables("works", "work_types", "expressions", "work_agents", "work_subjects", "edges")}, {_TYPES}, {_BODIES},
core AS (SELECT w.celex, w.work_uri, w.doc_date, w.in_force, (SELECT max(title) FROM expressions e WHERE e.work_uri = w.work_uri AND e.language_uri = '{dims.ENGLISH}') AS title,
  (SELECT min(type_uri) FROM work_types t WHERE t.work_uri = w.work_uri) AS type_uri FROM works w WHERE w.celex IS NOT NULL),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex ORDER BY title IS NULL, work_uri) AS n FROM core) WHERE n = 1),
au AS (SELECT celex, list(DISTINCT agent_uri) AS l FROM works JOIN work_agents USING (work_uri) GROUP BY celex),
lb AS (SELECT celex, string_agg(DISTINCT dst_uri, ' ' ORDER BY dst_uri) AS l FROM works JOIN edges ON src_uri = work_uri WHERE predicate = 'resource_legal_based_on_resource_legal' GROUP BY celex),
su AS (SELECT celex, string_agg(DISTINCT concept_uri, ' ' ORDER BY concept_uri) AS l FROM works JOIN work_subjects USING (work_uri) GROUP BY celex),
inst AS (SELECT celex, label, min(agent_uri) AS first FROM (SELECT DISTINCT celex, agent_uri, coalesce(n.label, list_extract(string_split(agent_uri, '/'), -1)) AS label
  FROM works JOIN work_agents USING (work_uri) LEFT JOIN body_names n ON n.uri = agent_uri WHERE celex IS NOT NULL) GROUP BY celex, label),
ins AS (SELECT celex, string_agg(label, '; ' ORDER BY first) AS l, arg_min(label, first) AS primary_ FROM inst GROUP BY celex)
SELECT one.celex AS celex_number, one.work_uri, coalesce(tn.label, list_extract(string_split(one.type_uri, '/'), -1)) AS resource_type, doc_date AS date, title, in_force,
  ins.primary_ AS author_institution, ins.l AS author_institutions, lb.l AS legal_basis, su.l AS eurovoc_subjects
FROM one LEFT JOIN type_names tn ON tn.uri = one.type_uri LEFT JOIN ins USING (celex) LEFT JOIN lb USING (celex) LEFT JOIN su USING (celex)"""


@query("meta_dimensions", _META)
def _(c: Corpus) -> DataFrame:
    found = document.metadata(c, c["works"].where(F.col("celex").isNotNull()).select("celex"))
    return found.withColumns({n: F.array_join(n, s) for n, s in (("author_institutions", "; "), ("legal_basis", " "), ("eurovoc_subjects", " "))})


@query("metadata_snapshot", f"SELECT celex_number, work_uri, resource_type, date, title, in_force, author_institution, author_institutions FROM ({_META}) WHERE celex_number LIKE '6%'")
def _(c: Corpus) -> DataFrame:
    found = document.metadata_snapshots(c, c["works"].where(F.startswith("celex", F.lit("6"))).select("celex"))
    return found.withColumn("author_institutions", F.array_join("author_institutions", "; "))


@query(
    "label_lookup_default",
    with_tables("work_types", "work_agents") + f", {_TYPES}, {_BODIES} SELECT u AS uri, coalesce(t.label, b.label, list_extract(string_split(u, '/'), -1)) AS label FROM (SELECT DISTINCT type_uri AS u FROM work_types UNION SELECT DISTINCT agent_uri FROM work_agents) LEFT JOIN type_names t ON t.uri = u LEFT JOIN body_names b ON b.uri = u",
)
def _(c: Corpus) -> DataFrame:
    uri = F.col("uri")
    uris = c["work_types"].select(F.col("type_uri").alias("uri")).union(c["work_agents"].select("agent_uri")).distinct()
    return uris.select("uri", F.when(F.startswith(uri, F.lit(dims.TYPE)), dims.type_label(uri)).otherwise(dims.body_label(uri)).alias("label"))


@query("staleness", _ROWS + r""", s AS (SELECT celex, min(work_uri) AS u FROM works WHERE celex LIKE '3%' GROUP BY celex)
SELECT celex, true AS is_superseded, max(related_celex) AS current_consolidated_celex, regexp_replace(max(related_celex), '^.*-([0-9]{4})([0-9]{2})([0-9]{2})$', '\1-\2-\3') AS consolidated_as_of
FROM rel JOIN s ON s.u = source_uri WHERE relation_type = 'consolidated_version' GROUP BY celex""")
def _(c: Corpus) -> DataFrame:
    return document.staleness(c, c["works"].where(F.startswith("celex", F.lit("3"))).select("celex"))


_USABLE = """ reps AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex, language ORDER BY CASE media_type WHEN 'application/xhtml+xml' THEN 1 ELSE 2 END, part_seq, body) AS n FROM contents
  WHERE length({STRIPPED}) >= 100 AND NOT contains(lower(substr(body, 1, 4096)), 'awswaf') AND NOT contains(lower(substr(body, 1, 4096)), 'gokuprops')) WHERE n = 1)""".replace("{STRIPPED}", _strip("body"))
_REPS = with_tables("contents") + "," + _USABLE


@query("content_cascade", _REPS + " SELECT celex, language, media_type, md5(body) AS body_md5, CAST(length(body) AS INTEGER) AS n_chars FROM reps")
def _(c: Corpus) -> DataFrame:
    return content.representations(c["contents"]).select("celex", "language", "media_type", F.md5(F.col("body").cast("binary")).alias("body_md5"), F.length("body").alias("n_chars"))


_FALL = _REPS + """, w AS (SELECT DISTINCT celex, r AS requested FROM contents, (VALUES ('FR'), ('DE'), ('EN'), ('IT')) v(r)),
f AS (SELECT w.*, a.body AS own, e.body AS eng FROM w LEFT JOIN reps a ON a.celex = w.celex AND a.language = w.requested LEFT JOIN reps e ON e.celex = w.celex AND e.language = 'EN')"""


def _wanted(c: Corpus) -> DataFrame:
    return c["contents"].select("celex").distinct().withColumn("requested", F.explode(F.array(*map(F.lit, ("FR", "DE", "EN", "IT")))))


@query("language_fallback", _FALL + """ SELECT celex, requested, coalesce(own, eng) IS NOT NULL AS available, CASE WHEN own IS NULL AND eng IS NOT NULL THEN 'EN' ELSE requested END AS language,
  own IS NULL AND eng IS NOT NULL AND requested <> 'EN' AS fallback, md5(coalesce(own, eng, '')) AS content_md5 FROM f""")
def _(c: Corpus) -> DataFrame:
    return content.in_language(c["contents"], _wanted(c)).select("celex", "requested", "available", "language", "fallback", F.md5(F.col("content").cast("binary")).alias("content_md5"))


@query("body_window", _FALL + """ SELECT celex, requested, CAST(least(500, length(b)) AS INTEGER) AS content_offset, CAST(length(substr(b, 501, 1000)) AS INTEGER) AS content_chars_returned, CAST(length(b) AS INTEGER) AS content_chars_total,
  least(500, length(b)) + length(substr(b, 501, 1000)) < length(b) AS has_more, md5(substr(b, 501, 1000)) AS window_md5 FROM (SELECT *, coalesce(own, eng, '') AS b FROM f)""")
def _(c: Corpus) -> DataFrame:
    shown = content.window(content.in_language(c["contents"], _wanted(c)), offset=500, limit=1000)
    return shown.select("celex", "requested", "content_offset", "content_chars_returned", "content_chars_total", "has_more", F.md5(F.col("window").cast("binary")).alias("window_md5"))


# Bodies of works: each document's text is the body of the work of its number, and of that work's consolidated version.
_BODIES_OF_WORKS = """SELECT w.celex, upper(d.lang) AS language, 'html' AS format, 'text/html' AS media_type, d.doc_id AS part_seq, d.text AS body
FROM (SELECT *, 'http://works.example/' || CAST(doc_id AS VARCHAR(20)) AS uri FROM {documents} UNION ALL SELECT *, 'http://works.example/c' || CAST(doc_id AS VARCHAR(20)) FROM {documents}) d JOIN {works} w ON w.work_uri = d.uri
WHERE w.celex IS NOT NULL AND d.text IS NOT NULL
UNION ALL SELECT w.celex, 'EN', 'html', 'application/xhtml+xml', d.doc_id, 'English: ' || d.text
FROM {documents} d JOIN {works} w ON w.work_uri = 'http://works.example/' || CAST(d.doc_id AS VARCHAR(20)) WHERE w.celex IS NOT NULL AND d.text IS NOT NULL AND d.doc_id % 2 = 0"""
_FETCH = (
    f"WITH meta AS ({_META}), stale AS ({_ROWS}"
    + r""" SELECT source_celex AS celex, max(related_celex) AS current_, regexp_replace(max(related_celex), '^.*-([0-9]{4})([0-9]{2})([0-9]{2})$', '\1-\2-\3') AS as_of
  FROM rel JOIN (SELECT celex, min(work_uri) AS u FROM works WHERE celex NOT LIKE '0%' GROUP BY celex) ON u = source_uri WHERE relation_type = 'consolidated_version' GROUP BY source_celex),
"""
    + with_tables("works").removeprefix("WITH ")
    + ",\ncontents AS ("
    + _BODIES_OF_WORKS.replace("{documents}", "documents").replace("{works}", "works")
    + "),"
    + _USABLE
    + """, req AS (SELECT DISTINCT celex AS identifier, 'celex' AS kind, 'FR' AS lang, 'current_consolidated' AS res, celex FROM works WHERE celex LIKE '3%'
  UNION ALL SELECT DISTINCT eli, 'eli', 'EN', 'as_requested', celex FROM works WHERE eli IS NOT NULL AND celex IS NOT NULL
  UNION ALL SELECT work_uri, 'work_uri', 'DE', 'current_consolidated', celex FROM works WHERE celex LIKE '0%'
  UNION ALL SELECT 'nothing', 'celex', 'EN', 'as_requested', NULL),
srv AS (SELECT req.*, stale.current_, stale.as_of, CASE WHEN res = 'current_consolidated' THEN coalesce(current_, req.celex) ELSE req.celex END AS served FROM req LEFT JOIN stale ON stale.celex = req.celex),
bod AS (SELECT srv.*, a.body AS own, e.body AS eng FROM srv LEFT JOIN reps a ON a.celex = served AND a.language = lang LEFT JOIN reps e ON e.celex = served AND e.language = 'EN')
SELECT identifier, kind, bod.celex AS requested_celex, served AS celex_number, current_ IS NOT NULL AS is_superseded, current_ AS current_consolidated_celex, as_of AS consolidated_as_of, meta.work_uri, meta.title, meta.author_institution,
  CASE WHEN served IS NOT NULL THEN coalesce(own, eng) IS NOT NULL END AS content_available, CASE WHEN served IS NOT NULL THEN CASE WHEN own IS NULL AND eng IS NOT NULL THEN 'EN' ELSE lang END END AS language,
  CASE WHEN served IS NOT NULL THEN own IS NULL AND eng IS NOT NULL AND lang <> 'EN' END AS language_fallback, CASE WHEN served IS NOT NULL THEN CAST(length(coalesce(own, eng, '')) AS INTEGER) END AS content_chars_total,
  CASE WHEN served IS NOT NULL THEN length(coalesce(own, eng, '')) > 1100 END AS has_more, CASE WHEN served IS NOT NULL THEN md5(substr(coalesce(own, eng, ''), 101, 1000)) END AS window_md5
FROM bod LEFT JOIN meta ON meta.celex_number = served"""
)


def _bodies_of_works(c: Corpus, offset: int, limit: int) -> DataFrame:
    """The same bodies: a document's representations are cut to their windows side by side, and meet the works of its number in one join."""
    number = F.col("doc_id").cast("string")
    text = c["documents"].where("text IS NOT NULL AND doc_id IS NOT NULL")
    own = F.struct(F.upper("lang").alias("language"), F.lit("text/html").alias("media_type"), F.col("text").alias("body"), F.lit(False).alias("english"))
    english = F.struct(F.lit("EN").alias("language"), F.lit("application/xhtml+xml").alias("media_type"), F.concat(F.lit("English: "), "text").alias("body"), F.lit(True).alias("english"))
    shown = text.select("doc_id", number.alias("number"), F.explode(F.when(F.col("doc_id") % 2 == 0, F.array(own, english)).otherwise(F.array(own))).alias("b"))
    shown = content.windows(shown.select("number", F.col("doc_id").alias("part_seq"), F.lit("html").alias("format"), "b.*"), offset, limit)
    uri = "http://works.example/"
    name = F.regexp_extract("work_uri", f"^{uri}(c?)([0-9]+|-[0-9]+)$", 2)
    works = c["works"].where("celex IS NOT NULL").select("celex", name.alias("number"), F.startswith("work_uri", F.lit(uri + "c")).alias("version")).where("number <> ''")
    return shown.join(works, "number").where("NOT (english AND version)").drop("number", "english", "version")


@query("document_fetch", _FETCH)
def _(c: Corpus) -> DataFrame:
    spark, works = c.spark, c["works"]
    given = Corpus(spark, c.folder, contents=_bodies_of_works(c, offset=100, limit=1000))
    ask = lambda df, column, kind, language, resolve: df.select(F.col(column).alias("identifier"), F.lit(kind).alias("kind"), F.lit(language).alias("language"), F.lit(resolve).alias("resolve"))
    known = works.where(F.col("celex").isNotNull())
    requests = ask(known.where("celex LIKE '3%'").select("celex").distinct(), "celex", "celex", "FR", "current_consolidated").unionByName(ask(known.where("eli IS NOT NULL"), "eli", "eli", "EN", "as_requested"))
    requests = requests.unionByName(ask(known.where("celex LIKE '0%'"), "work_uri", "work_uri", "DE", "current_consolidated")).unionByName(ask(spark.range(1).select(F.lit("nothing").alias("x")), "x", "celex", "EN", "as_requested"))
    found = document.documents(given, requests, offset=100, limit=1000, fields=("title", "author_institution"))
    columns = "identifier kind requested_celex celex_number is_superseded current_consolidated_celex consolidated_as_of work_uri title author_institution content_available language language_fallback content_chars_total has_more".split()
    return found.select(*columns, F.md5(F.col("content").cast("binary")).alias("window_md5"))


@query("multipart_assemble", with_tables("parts") + """ SELECT doc, count(*) AS n_parts, CASE WHEN bool_and(NOT (body IS NULL OR (doc + seq) % 13 = 0)) THEN md5('<documents>' || chr(10) || string_agg({STRIPPED}, chr(10) ORDER BY seq, body) || chr(10) || '</documents>') END AS body_md5 FROM parts GROUP BY doc""".replace("{STRIPPED}", _strip("body")))
def _(c: Corpus) -> DataFrame:
    parts = c["parts"].withColumn("body", F.when((F.col("doc") + F.col("seq")) % 13 != 0, F.col("body")))
    return content.assemble(parts).select("doc", "n_parts", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@query(
    "multipart_urls",
    with_tables("parts")
    + """, u AS (SELECT doc, seq, '/resource/' || CAST(doc AS VARCHAR) || '/' || CASE WHEN seq % 4 = 3 THEN 'x' || CAST(seq AS VARCHAR) ELSE 'DOC_' || CAST(seq AS VARCHAR) || '?a=1&b=2' END AS url, CASE WHEN seq % 4 = 3 THEN NULL ELSE seq END AS n FROM (SELECT DISTINCT doc, seq FROM parts))
SELECT doc, string_agg(url, ' ' ORDER BY n NULLS LAST, seq DESC) AS urls FROM u GROUP BY doc""",
)
def _(c: Corpus) -> DataFrame:
    """Indexes that list their parts backwards, each twice."""
    name = F.when(F.col("seq") % 4 == 3, F.concat(F.lit("x"), F.col("seq").cast("string"))).otherwise(F.concat(F.lit("DOC_"), F.col("seq").cast("string"), F.lit("?a=1&amp;b=2")))
    link = F.concat(F.lit('<li><a href="/resource/'), F.col("doc").cast("string"), F.lit("/"), name, F.lit('">part</a></li>'))
    ordered = F.sort_array(F.collect_set(F.struct("seq", link.alias("a"))), asc=False)
    index = F.array_join(F.concat(F.transform(ordered, lambda x: x["a"]), F.transform(ordered, lambda x: x["a"])), "\n")
    return c["parts"].groupBy("doc").agg(index.alias("index")).select("doc", F.array_join(content.part_urls(F.col("index")), " ").alias("urls"))


@query(
    "visible_text",
    r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi'), '&lt;', '<'), '&gt;', '>'), '\s+', ' ', 'g'))) AS text_md5 FROM pages""",
)
def _(c: Corpus) -> DataFrame:
    return c["pages"].select("page_id", F.md5(text.visible(F.col("html")).cast("binary")).alias("text_md5"))


@query("json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(c: Corpus) -> DataFrame:
    return c["events"].select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# --- structure ---

_VISIBLE = r"trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(line, '<[^>]*>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi'), '&lt;', '<'), '&gt;', '>'), '\s+', ' ', 'g'))"
_HEADS = (
    with_tables("lines", "act_lines")
    + rf""", v AS (SELECT doc_id, line_no, {_VISIBLE} AS v, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ FROM act_lines),
k AS (SELECT *, CASE WHEN regexp_matches(v, '^Article\s+([0-9]+[a-z]?)\s*$') THEN 'article' WHEN regexp_matches(v, '^(?i)CHAPTER\s+([IVXLCDM]+|[0-9]+)\s*$') THEN 'chapter'
  WHEN regexp_matches(v, '^(?i)SECTION\s+([IVXLCDM]+|[0-9]+)\s*$') THEN 'section' WHEN regexp_matches(v, '^ANNEX(\s+([IVXLCDM]+|[0-9]+|[A-Z]))?(\s*[-–—:.]\s*(.*))?\s*$') THEN 'annex' END AS st FROM v),
n AS (SELECT *, (SELECT min(b.line_no) FROM k b WHERE b.doc_id = k.doc_id AND b.line_no > k.line_no AND b.v <> '') AS nx, min(CASE WHEN st IN ('article', 'chapter', 'section') THEN offset_ END) OVER (PARTITION BY doc_id) AS en FROM k),
h AS (SELECT n.doc_id, coalesce(n.st, 'recital') AS kind,
  CASE n.st WHEN 'article' THEN upper(regexp_extract(n.v, '^Article\s+([0-9]+[a-z]?)', 1)) WHEN 'annex' THEN upper(regexp_extract(n.v, '^ANNEX(\s+([IVXLCDM]+|[0-9]+|[A-Z]))?', 2))
    WHEN 'chapter' THEN upper(regexp_extract(n.v, '\s([^ ]+)$', 1)) WHEN 'section' THEN upper(regexp_extract(n.v, '\s([^ ]+)$', 1)) ELSE regexp_extract(n.v, '^\(([0-9]+)\)', 1) END AS number,
  CASE WHEN n.st IS NOT NULL THEN coalesce(CASE WHEN n.st = 'annex' THEN nullif(trim(regexp_extract(n.v, '^ANNEX(\s+([IVXLCDM]+|[0-9]+|[A-Z]))?\s*[-–—:.]\s*(.*)$', 3)), '') END, CASE WHEN f.st IS NULL AND length(f.v) <= 200 THEN f.v END) END AS title, n.offset_ AS "offset"
  FROM n LEFT JOIN k f ON f.doc_id = n.doc_id AND f.line_no = n.nx WHERE n.st IS NOT NULL OR (regexp_matches(n.v, '^\([0-9]+\)(\s|$)') AND n.offset_ < n.en)),
heads AS (SELECT doc_id, kind, number, CASE WHEN kind = 'annex' AND number = '' THEN 'ANNEX' ELSE CASE kind WHEN 'article' THEN 'Article' WHEN 'chapter' THEN 'CHAPTER' WHEN 'section' THEN 'Section' WHEN 'annex' THEN 'ANNEX' ELSE 'Recital' END || ' ' || number END AS label, title, "offset" FROM h)"""
)


@query("outline_offsets", _HEADS + " SELECT * FROM heads")
def _(c: Corpus) -> DataFrame:
    return structure.outline_lines(c["act_lines"])


@query(
    "section_select",
    _HEADS
    + """, q(ordinal, kind, token) AS (VALUES (0, 'article', '7A'), (1, 'article', '12'), (2, 'chapter', '1'), (3, 'chapter', 'IV'), (4, 'recital', '1'), (5, 'annex', '2'), (6, 'annex', 'I')),
num(r, a) AS (VALUES ('I', '1'), ('II', '2'), ('IV', '4')), req AS (SELECT DISTINCT l.doc_id, q.* FROM act_lines l, q),
rk AS (SELECT *, CASE kind WHEN 'chapter' THEN 1 WHEN 'annex' THEN 1 WHEN 'section' THEN 2 WHEN 'article' THEN 3 ELSE 4 END AS rank_ FROM heads),
hit AS (SELECT r.doc_id, r.ordinal, min(h."offset") AS start FROM req r JOIN rk h ON h.doc_id = r.doc_id AND h.kind = r.kind AND (h.number = r.token OR coalesce((SELECT a FROM num WHERE num.r = h.number), h.number) = coalesce((SELECT a FROM num WHERE num.r = r.token), r.token)) GROUP BY r.doc_id, r.ordinal)
SELECT r.doc_id, r.ordinal, r.kind, r.token, h.label AS matched, hit.start, (SELECT min(z."offset") FROM rk z WHERE z.doc_id = r.doc_id AND z."offset" > hit.start AND z.rank_ <= h.rank_) AS "end"
FROM req r LEFT JOIN hit ON hit.doc_id = r.doc_id AND hit.ordinal = r.ordinal LEFT JOIN rk h ON h.doc_id = r.doc_id AND h."offset" = hit.start""",
)
def _(c: Corpus) -> DataFrame:
    asked = [(0, "article", "7A"), (1, "article", "12"), (2, "chapter", "1"), (3, "chapter", "IV"), (4, "recital", "1"), (5, "annex", "2"), (6, "annex", "I")]
    requests = c["act_lines"].select("doc_id").distinct().join(F.broadcast(c.spark.createDataFrame(asked, "ordinal int, kind string, token string")))
    return structure.sections(structure.outline_lines(c["act_lines"]), requests)


_ASKED = {"articles": "7a, Article 12", "chapters": "1,IV,", "recitals": " recital 1", "annexes": "2,annex i"}


@query(
    "section_text",
    f"WITH sel AS ({ORACLE_SQL['section_select']}), b AS ({with_tables('lines', 'act_lines')} SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS body FROM act_lines GROUP BY doc_id),"
    + """ named AS (SELECT *, CASE kind WHEN 'article' THEN 'Article' WHEN 'chapter' THEN 'CHAPTER' WHEN 'annex' THEN 'ANNEX' ELSE 'Recital' END || ' ' || token AS name,
  row_number() OVER (PARTITION BY doc_id, start ORDER BY ordinal) AS n, CASE kind WHEN 'annex' THEN 10 ELSE 0 END + ordinal AS place FROM sel),
cut AS (SELECT doc_id, string_agg({STRIPPED}, chr(10) || chr(10) ORDER BY start) AS text FROM (SELECT doc_id, start, substr(body, start + 1, coalesce("end", length(body)) - start) AS part FROM named JOIN b USING (doc_id) WHERE start IS NOT NULL AND n = 1) GROUP BY doc_id)
SELECT doc_id, string_agg(name, '|' ORDER BY ordinal) AS requested, coalesce(string_agg(matched, '|' ORDER BY start, ordinal) FILTER (start IS NOT NULL), '') AS matched, coalesce(string_agg(name, '|' ORDER BY ordinal) FILTER (start IS NULL), '') AS missed,
  md5(coalesce(min(cut.text), '')) AS text_md5 FROM named LEFT JOIN cut USING (doc_id) GROUP BY doc_id""".replace("{STRIPPED}", _strip("part")),
)
def _(c: Corpus) -> DataFrame:
    lines = c["act_lines"]
    bodies = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l")).select("doc_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("body"))
    requests = structure.asked(bodies.select("doc_id", *[F.lit(v).alias(k) for k, v in _ASKED.items()]))
    found = structure.selections(bodies, structure.outline_lines(lines), requests)
    return found.select("doc_id", *[F.array_join(n, "|").alias(n) for n in ("requested", "matched", "missed")], F.md5(F.col("text").cast("binary")).alias("text_md5"))


_ROMAN = "coalesce(nullif(list_sum(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN {v} < coalesce(list_max(list_transform(range(i + 1, length(t) + 1), lambda j: {w})), 0) THEN -({v}) ELSE {v} END)), 0), 0)"
_LETTER = "CASE substr(t, {0}, 1) WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 WHEN 'M' THEN 1000 ELSE 0 END"


@query(
    "roman_equivalence",
    "WITH d AS (SELECT DISTINCT p_size, repeat('X', CAST(floor(p_size / 10) AS INTEGER)) || CASE p_size % 10 WHEN 0 THEN '' WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'IV' WHEN 5 THEN 'V' WHEN 6 THEN 'VI' WHEN 7 THEN 'VII' WHEN 8 THEN 'VIII' ELSE 'IX' END AS t FROM part) "
    f"SELECT p_size, t AS numeral, CAST({_ROMAN.format(v=_LETTER.format('i'), w=_LETTER.format('j'))} AS INTEGER) AS value, p_size = {_ROMAN.format(v=_LETTER.format('i'), w=_LETTER.format('j'))} AS same FROM d WHERE p_size > 0",
)
def _(c: Corpus) -> DataFrame:
    ones = F.array(*map(F.lit, ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")))
    sizes = c["part"].where("p_size > 0").select("p_size").distinct()
    numerals = sizes.select("p_size", F.concat(F.repeat(F.lit("X"), F.floor(F.col("p_size") / 10).cast("int")), F.get(ones, F.col("p_size") % 10)).alias("numeral"))
    return numerals.select("p_size", "numeral", text.roman(F.col("numeral")).alias("value"), text.same_number(F.col("p_size").cast("string"), F.col("numeral")).alias("same"))


@query("page_markdown")
def _(c: Corpus) -> DataFrame:
    return markdown.render(c["pages"].select("page_id", "html"), "html")


@query(
    "xml_outline",
    with_tables("lines")
    + f""" SELECT CAST(doc_id AS VARCHAR) AS celex, 'article' AS kind, CAST(line_no AS VARCHAR) AS number, 'Article ' || line_no AS label, nullif({_VISIBLE}, '') AS title,
  CAST(coalesce(sum(45 + length(CAST(line_no AS VARCHAR)) + length(line)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM lines""",
)
def _(c: Corpus) -> DataFrame:
    """Documents as XML acts: each line an article with a title."""
    lines = c["lines"].groupBy(F.col("doc_id").cast("string").alias("celex")).agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: F.concat(F.lit("<TI.ART>Article "), x["line_no"].cast("string"), F.lit("</TI.ART><STI.ART>"), x["line"], F.lit("</STI.ART>"))), "\n")
    return structure.outlines(lines.select("celex", body.alias("body"))).select("celex", F.explode("outline").alias("h")).select("celex", "h.*")


# Documents as XML acts with every element; the lines' own brackets would be tags.
_XML = """CASE WHEN line_no % 11 = 4 THEN '<TI><P>Chapter ' || CASE line_no % 3 WHEN 0 THEN 'iv' ELSE '7' END || '</P></TI> <STI><P>' || t || '</P></STI>'
  WHEN line_no % 13 = 12 THEN '<TITLE><TI><P>SECTION ' || CAST(line_no AS VARCHAR(20)) || ' <HT>x</HT></P></TI></TITLE><STI><P>' || t || '</P></STI>'
  WHEN line_no % 5 = 2 THEN '<TI.ART>Article ' || CAST(line_no AS VARCHAR(20)) || CASE line_no % 2 WHEN 0 THEN '' ELSE 'b' END || '</TI.ART>' || CASE line_no % 3 WHEN 0 THEN '' ELSE '<STI.ART><HT>' || t || '</HT></STI.ART>' END
  WHEN line_no % 3 = 1 THEN '<NP><NO.P>(' || CAST(line_no AS VARCHAR(20)) || ')</NO.P><TXT>' || t || '</TXT></NP>' ELSE '<P>' || t || '</P>' END"""
_XML_LINES = "SELECT doc_id, line_no, t, {xml} AS x FROM (SELECT doc_id, line_no, translate(line, '<>&', '   ') AS t FROM {lines})".replace("{xml}", _XML)


@query(
    "xml_act_outline",
    with_tables("lines")
    + f""", x AS ({_XML_LINES.replace("{lines}", "lines")}),
o AS (SELECT *, CAST(coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_, nullif({_VISIBLE.replace("line", "t")}, '') AS v FROM x),
f AS (SELECT *, min(CASE WHEN line_no % 5 = 2 AND line_no % 11 <> 4 AND line_no % 13 <> 12 THEN at_ END) OVER (PARTITION BY doc_id) AS first_ FROM o)
SELECT CAST(doc_id AS VARCHAR) AS celex, CASE WHEN line_no % 11 = 4 THEN 'chapter' WHEN line_no % 13 = 12 THEN 'section' WHEN line_no % 5 = 2 THEN 'article' ELSE 'recital' END AS kind,
  CASE WHEN line_no % 11 = 4 THEN CASE line_no % 3 WHEN 0 THEN 'IV' ELSE '7' END WHEN line_no % 13 <> 12 AND line_no % 5 = 2 AND line_no % 2 <> 0 THEN line_no || 'B' ELSE CAST(line_no AS VARCHAR) END AS number,
  CASE WHEN line_no % 11 = 4 THEN 'CHAPTER ' || CASE line_no % 3 WHEN 0 THEN 'IV' ELSE '7' END WHEN line_no % 13 = 12 THEN 'Section ' || line_no
    WHEN line_no % 5 = 2 THEN 'Article ' || line_no || CASE line_no % 2 WHEN 0 THEN '' ELSE 'b' END ELSE 'Recital ' || line_no END AS label,
  CASE WHEN line_no % 11 = 4 THEN v WHEN line_no % 13 <> 12 AND line_no % 5 = 2 AND line_no % 3 <> 0 THEN v END AS title,
  at_ + CASE WHEN line_no % 11 = 4 THEN 0 WHEN line_no % 13 = 12 THEN 7 WHEN line_no % 5 = 2 THEN 0 ELSE 4 END AS "offset"
FROM f WHERE line_no % 11 = 4 OR line_no % 13 = 12 OR line_no % 5 = 2 OR (line_no % 3 = 1 AND at_ + 4 < coalesce(first_, 9000000000000))""",
)
def _(c: Corpus) -> DataFrame:
    lines = c.spark.sql(_XML_LINES, lines=c["lines"]).groupBy(F.col("doc_id").cast("string").alias("celex")).agg(F.array_sort(F.collect_list(F.struct("line_no", "x"))).alias("l"))
    acts = lines.select("celex", F.array_join(F.transform("l", lambda x: x["x"]), "\n").alias("body"))
    return structure.outlines(acts).select("celex", F.explode("outline").alias("h")).select("celex", "h.*")


# --- ad-hoc queries, rendering, streams ---

_ADHOC = "SELECT type_uri, count(*) AS n, min(doc_date) AS first FROM works JOIN work_types USING (work_uri) GROUP BY type_uri ORDER BY n DESC, type_uri LIMIT 1000"


@query("adhoc_limit_ceiling", with_tables("works", "work_types") + " " + _ADHOC.replace("1000", "5"))
def _(c: Corpus) -> DataFrame:
    return adhoc.select(c, _ADHOC, ceiling=5).df


@query("render_records", with_tables("works") + """ SELECT '### ' || work_uri || CASE WHEN celex IS NULL THEN '' ELSE chr(10) || '- **celex:** ' || celex END || CASE WHEN in_force IS NULL THEN '' ELSE chr(10) || '- **in_force:** ' || CAST(in_force AS VARCHAR) END AS text FROM works""")
def _(c: Corpus) -> DataFrame:
    return render.as_text(c["works"].select("work_uri", "celex", "in_force"), "work_uri")


@query("terms_turtle", with_tables("works") + """ SELECT work_uri, '<' || work_uri || '>' AS subject, CASE WHEN celex IS NOT NULL THEN '"' || celex || '"' END AS celex_term, '"' || CAST(doc_date AS VARCHAR) || '"^^xsd:date' AS date_term FROM works""")
def _(c: Corpus) -> DataFrame:
    none = F.lit(None).cast("string")
    date = text.term(F.lit("literal"), F.col("doc_date").cast("string"), F.lit("http://www.w3.org/2001/XMLSchema#date"), none)
    return c["works"].select("work_uri", text.term(F.lit("uri"), F.col("work_uri"), none, none).alias("subject"), text.term(F.lit("literal"), F.col("celex"), none, none).alias("celex_term"), date.alias("date_term"))


@query("events_tumbling", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def _(c: Corpus) -> DataFrame:
    return event_counts(c["events"])


from nomograph import index_queries, graph_queries  # noqa: E402, F401, I001  further queries of this module's kind
