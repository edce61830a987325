"""The legal-knowledge tables over a folder of carrier tables.

Each table is one statement of portable SQL, so that the same definition serves Spark and any other engine that
checks results. The tables are lazy: a query reads the columns and rows that it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nomograph.functions.dims import AUTHORITY, BODY, CONCEPT, ELI, TYPE
from nomograph.plans.config import Settings

_NUMBER = "lpad(CAST(o_orderkey % 10000 AS VARCHAR(20)), 4, '0')"
_YEAR = "CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR(20))"
_LETTERS = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
  CASE o_orderkey % 5 WHEN 0 THEN 'CC' WHEN 1 THEN 'TJ' WHEN 2 THEN 'CO' ELSE 'CJ' END
  ELSE CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'L' ELSE 'D' END END"""
_SECTOR = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '6' ELSE '3' END"
_LATER = "(CAST(o_orderdate AS DATE) + 100)"
_STAMP = f"CAST(year({_LATER}) AS VARCHAR(20)) || lpad(CAST(month({_LATER}) AS VARCHAR(20)), 2, '0') || lpad(CAST(day({_LATER}) AS VARCHAR(20)), 2, '0')"

#: name -> statement over {carrier tables} and other tables here, in an order in which each uses earlier ones.
TABLES: dict[str, str] = {
    # Acts and cases; one in 97 has no CELEX; the number's modulus gives several works the same CELEX. One in 11
    # acts has a consolidated version, a work of its own.
    "works": f"""
SELECT 'http://works.example/' || CAST(o_orderkey AS VARCHAR(20)) AS work_uri,
  CASE WHEN o_orderkey % 97 <> 0 THEN {_SECTOR} || {_YEAR} || {_LETTERS} || {_NUMBER} END AS celex,
  CAST(o_orderdate AS DATE) AS doc_date, o_orderstatus = 'F' AS in_force,
  '{ELI}' || CASE o_orderstatus WHEN 'F' THEN 'reg' WHEN 'O' THEN 'dir' ELSE 'dec' END || '/' || {_YEAR} || '/'
    || CAST(o_orderkey AS VARCHAR(20)) || CASE WHEN o_orderkey % 2 = 0 THEN '/oj' ELSE '' END AS eli
FROM {{orders}}
UNION ALL
SELECT 'http://works.example/c' || CAST(o_orderkey AS VARCHAR(20)), '0' || {_YEAR} || {_LETTERS} || {_NUMBER} || '-' || {_STAMP},
  {_LATER}, CAST(NULL AS BOOLEAN), CAST(NULL AS VARCHAR(200))
FROM {{orders}} WHERE o_orderkey % 11 = 0 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    "work_types": f"""
SELECT 'http://works.example/' || CAST(o_orderkey AS VARCHAR(20)) AS work_uri, '{TYPE}' ||
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CASE o_orderkey % 5 WHEN 0 THEN 'OPIN_AG' WHEN 2 THEN 'ORDER' ELSE 'JUDG' END
  ELSE CASE o_orderstatus WHEN 'F' THEN 'REG' WHEN 'O' THEN 'DIR' ELSE 'DEC' END END AS type_uri
FROM {{orders}} WHERE o_orderkey % 89 <> 0
UNION ALL
SELECT 'http://works.example/' || CAST(o_orderkey AS VARCHAR(20)), '{TYPE}' || CASE WHEN o_orderkey % 14 = 0 THEN 'INFO_JUR' ELSE 'CORRIGENDUM' END
FROM {{orders}} WHERE o_orderkey % 7 = 0
UNION ALL
SELECT 'http://works.example/c' || CAST(o_orderkey AS VARCHAR(20)), '{TYPE}CONS_TEXT'
FROM {{orders}} WHERE o_orderkey % 11 = 0 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    "expressions": f"""
SELECT 'http://works.example/' || CAST(l_orderkey AS VARCHAR(20)) || '.' || CAST(l_linenumber AS VARCHAR(20)) AS expr_uri,
  'http://works.example/' || CAST(l_orderkey AS VARCHAR(20)) AS work_uri,
  '{AUTHORITY}/language/' || CASE l_linenumber WHEN 1 THEN 'ENG' WHEN 2 THEN 'FRA' ELSE 'DEU' END AS language_uri,
  CASE l_orderkey % 6 WHEN 0 THEN p_name WHEN 1 THEN 'Judgment of the Court.#' || p_name || ' v ' || p_brand || '.#' || p_type || '.#Case C-' || CAST(l_orderkey % 900 AS VARCHAR(20)) || '/12.'
    WHEN 2 THEN 'Order.#' || p_name || '.#Request for a ruling.#' || p_type || '.#Cases T-1/18 and T-2/18.'
    WHEN 3 THEN 'Opinion of ' || p_brand || '.###' WHEN 4 THEN p_brand || '#' || p_name || '#' || p_type ELSE p_type || ' ' || p_name END AS title
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey WHERE l_linenumber <= 3""",
    "work_subjects": f"""
SELECT DISTINCT 'http://works.example/' || CAST(l_orderkey AS VARCHAR(20)) AS work_uri, '{CONCEPT}' || CAST(l_partkey AS VARCHAR(20)) AS concept_uri FROM {{lineitem}}""",
    "work_agents": f"""
SELECT DISTINCT 'http://works.example/' || CAST(l_orderkey AS VARCHAR(20)) AS work_uri, '{BODY}' ||
  CASE l_suppkey % 8 WHEN 0 THEN 'EP' WHEN 1 THEN 'CONSIL' WHEN 2 THEN 'COM' WHEN 3 THEN 'EMA' WHEN 4 THEN 'EMEA' ELSE 'A' || CAST(l_suppkey AS VARCHAR(20)) END AS agent_uri
FROM {{lineitem}}""",
    "agent_labels": f"""
SELECT DISTINCT '{BODY}A' || CAST(s_suppkey AS VARCHAR(20)) AS agent_uri, 'en' AS lang, s_name || ' (' || n_name || ')' AS label
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
UNION ALL
SELECT DISTINCT '{BODY}A' || CAST(s_suppkey AS VARCHAR(20)), 'fr', n_name || ', ' || s_name FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "edges": """
SELECT DISTINCT 'http://works.example/' || CAST(a.l_orderkey AS VARCHAR(20)) AS src_uri,
  CASE a.l_linenumber % 4 WHEN 0 THEN 'work_cites_work' WHEN 1 THEN 'resource_legal_amends_resource_legal' WHEN 2 THEN 'resource_legal_repeals_resource_legal' ELSE 'resource_legal_based_on_resource_legal' END AS predicate,
  'http://works.example/' || CAST(b.l_orderkey AS VARCHAR(20)) AS dst_uri
FROM {lineitem} a JOIN {lineitem} b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_orderkey > b.l_orderkey
UNION ALL
SELECT 'http://works.example/c' || CAST(o_orderkey AS VARCHAR(20)), 'act_consolidated_consolidates_resource_legal', 'http://works.example/' || CAST(CASE WHEN o_orderkey % 33 = 0 THEN o_orderkey - 32 ELSE o_orderkey END AS VARCHAR(20))
FROM {orders} WHERE o_orderkey % 11 = 0 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
    "concepts": f"SELECT '{CONCEPT}' || CAST(p_partkey AS VARCHAR(20)) AS concept_uri FROM {{part}} UNION ALL SELECT 'http://other.example/' || p_brand FROM {{part}} GROUP BY p_brand",
    "concept_labels": f"""
SELECT '{CONCEPT}' || CAST(p_partkey AS VARCHAR(20)) AS concept_uri, 'en' AS lang, p_name AS label FROM {{part}}
UNION ALL SELECT '{CONCEPT}' || CAST(p_partkey AS VARCHAR(20)), 'fr', p_brand || ' ' || p_name FROM {{part}}
UNION ALL SELECT 'http://other.example/' || p_brand, 'en', min(p_name) FROM {{part}} GROUP BY p_brand""",
    "concept_notations": f"SELECT '{CONCEPT}' || CAST(p_partkey AS VARCHAR(20)) AS concept_uri, p_type AS notation FROM {{part}} WHERE p_partkey % 3 <> 0",
    "concept_broader": f"SELECT '{CONCEPT}' || CAST(p_partkey AS VARCHAR(20)) AS concept_uri, '{CONCEPT}' || CAST(p_partkey % 40 + 1 AS VARCHAR(20)) AS broader_uri FROM {{part}} WHERE p_partkey > 40",
    # Bodies by CELEX, language, format and media type: one in five lacks its language's main representation.
    "contents": """
SELECT '3' || CAST(2000 + doc_id % 20 AS VARCHAR(20)) || 'R' || lpad(CAST((doc_id - doc_id % 3) % 10000 AS VARCHAR(20)), 4, '0') AS celex, upper(lang) AS language, 'html' AS format,
  CASE WHEN doc_id % 5 = 0 THEN 'text/html' ELSE 'application/xhtml+xml' END AS media_type, doc_id AS part_seq, text AS body
FROM {documents} WHERE text IS NOT NULL
UNION ALL
SELECT '3' || CAST(2000 + doc_id % 20 AS VARCHAR(20)) || 'R' || lpad(CAST((doc_id - doc_id % 3) % 10000 AS VARCHAR(20)), 4, '0'), 'EN', 'html', 'text/html', doc_id, 'English: ' || text
FROM {documents} WHERE text IS NOT NULL AND doc_id % 4 = 0""",
    "parts": "SELECT conv_id AS doc, turn AS seq, text AS body FROM {conversations}",
    # Acts with headings: a document's lines, some of them replaced by headings.
    "act_lines": """
SELECT doc_id, line_no, CASE WHEN doc_id % 9 = 0 THEN line
  WHEN line_no % 11 = 4 THEN 'CHAPTER ' || CASE line_no % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'iv' ELSE '7' END
  WHEN line_no % 5 = 2 AND line_no > 4 THEN 'Article ' || CAST(line_no AS VARCHAR(20)) || CASE WHEN line_no % 2 = 0 THEN '' ELSE 'a' END
  WHEN line_no % 13 = 12 THEN 'ANNEX ' || CASE line_no % 2 WHEN 0 THEN 'I' ELSE 'II - ' || line END
  WHEN line_no % 3 = 1 THEN '(' || CAST(line_no AS VARCHAR(20)) || ') ' || line WHEN line_no % 7 = 6 THEN '<p class="x">' || line || '</p>' ELSE line END AS line
FROM {lines}""",
}
CARRIERS = ("orders", "lineitem", "part", "supplier", "nation", "documents", "conversations")
#: A document's lines, numbered from 0: the one statement that engines spell differently.
LINES_SPARK = "SELECT doc_id, pos AS line_no, line FROM {documents} LATERAL VIEW posexplode(split(text, '\\n')) AS pos, line WHERE text IS NOT NULL"
LINES_OTHER = "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, list_extract(l, i) AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"


class Corpus:
    """The tables as lazy DataFrames: corpus["works"], and so on. Tables given by name replace the derived ones."""

    def __init__(self, spark: SparkSession, folder: str | None = None, settings: Settings | None = None, **tables: DataFrame):
        self.spark, self.folder, self.settings, self.given = spark, folder, settings or Settings(), dict(tables)
        #: An index of English titles (fulltext.PhraseIndex) that searches use in place of the titles, if there is one.
        self.titles = None
        self._derived: dict[str, DataFrame | None] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.given:
            statement = LINES_SPARK if name == "lines" else TABLES.get(name)
            if statement is None:
                self.given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                used = {t: self[t] for t in (*CARRIERS, "lines") if "{" + t + "}" in statement}
                self.given[name] = self.spark.sql(statement, **used)
                self._derived[name] = self.given[name]
        return self.given[name]

    def repeated(self, name: str) -> DataFrame:
        """The table, but rows may come several times: for operators that make sets themselves, so that rows aren't shuffled twice for it."""
        if name in self.given and name not in self._derived or " DISTINCT " not in TABLES.get(name, ""):
            return self[name]
        key = f"{name}, repeated"
        if key not in self._derived:
            statement = TABLES[name].replace("SELECT DISTINCT", "SELECT")
            self._derived[key] = self.spark.sql(statement, **{t: self[t] for t in (*CARRIERS, "lines") if "{" + t + "}" in statement})
        return self._derived[key]

    def tables(self) -> list[str]:
        """The names of the tables that there are: all with a folder, else those given."""
        return list(TABLES) if self.folder is not None else [n for n in TABLES if n in self.given]


def with_tables(*names: str) -> str:
    """WITH clause that defines the named tables over views of the carrier tables, for other engines."""
    parts = []
    for name in names:
        if name == "lines":
            parts.append(f"lines AS ({LINES_OTHER})")
            continue
        statement = TABLES[name]
        for t in (*CARRIERS, "lines"):
            statement = statement.replace("{" + t + "}", t)
        parts.append(f"{name} AS ({statement})")
    return "WITH " + ",\n".join(parts)
