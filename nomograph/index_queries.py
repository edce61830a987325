"""Queries that first write an index or a mirror to the shared folder and then read it in place of the tables; facets and sessions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.operators import adhoc, facets, search
from nomograph.operators.fulltext import K1, B, PhraseIndex, RankedIndex
from nomograph.plans.requests import SearchRequest
from nomograph.queries import _NORM, ORACLE_SQL, query
from nomograph.session import checkpoint_dir
from nomograph.sources import service
from nomograph.sources.corpus import Corpus, with_tables
from nomograph.sources.mirror import Mirror
from nomograph.streaming.sessions import sessions


def _new_folder(c: Corpus, name: str) -> str:
    return f"{checkpoint_dir(c.spark)}/{name}-{uuid.uuid4().hex}"


def index_titles(c: Corpus) -> Corpus:
    """The corpus with an index of its English titles."""
    titles = search.english(c).select(F.col("work_uri").alias("key"), F.col("title").alias("text"))
    c.titles = PhraseIndex.build(titles, _new_folder(c, "titles"))
    return c


@query("title_phrase_index", ORACLE_SQL["search_title_phrase"])
def _(c: Corpus) -> DataFrame:
    """The same search as search_title_phrase; titles are read from posting lists and the index's own texts."""
    return search.search_documents(index_titles(c), SearchRequest(keyword="judgment of: the COURT", limit=100))


#: Query number -> what is asked of the bodies.
_ASKED = {1: "the theron tiin", 2: "de la étre", 3: "und erkeit enzu", 4: "Idiot! trash", 5: "under the licence", 6: "in in the", 7: "nowhereatall"}
_BM25 = f"""WITH d AS (SELECT doc_id, list_filter(string_split({_NORM.format("text")}, ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d WHERE len(w) > 0),
q(query, text) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in _ASKED.items())}),
t AS (SELECT query, word, count(*) AS times FROM (SELECT query, unnest(list_filter(string_split({_NORM.format("text")}, ' '), lambda x: x <> '')) AS word FROM q) GROUP BY ALL),
p AS (SELECT doc_id, dl, word, count(*) AS tf FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM t) GROUP BY ALL),
f AS (SELECT word, count(*) AS df FROM p GROUP BY word),
r AS (SELECT query, doc_id, sum(times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * dl / mean))) AS score
  FROM t JOIN p USING (word) JOIN f USING (word), s GROUP BY query, doc_id)
SELECT * FROM (SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank, doc_id, round(score, 9) AS score FROM r) WHERE rank <= 20"""


@query("search_body_ranked", _BM25)
def _(c: Corpus) -> DataFrame:
    """The twenty best documents for each of a few queries, over all documents' texts."""
    index = RankedIndex.build(c["documents"].select(F.col("doc_id").alias("id"), "text"), _new_folder(c, "bodies"))
    found = index.search(c.spark.createDataFrame(list(_ASKED.items()), "query int, text string"), 20)
    return found.select("query", "rank", F.col("id").alias("doc_id"), F.round("score", 9).alias("score"))


_MIRROR = "event_type string, value double, ts timestamp"


def _feed(c: Corpus) -> DataFrame:
    """Events as changes to their users: the last tells a user's state, an error or a signup deletes it."""
    return c["events"].select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").isin("error", "signup").alias("deleted"), "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))


@query("mirror_merge", "SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup') AND event_id IN (SELECT max(event_id) FROM events GROUP BY user_id)")
def _(c: Corpus) -> DataFrame:
    """A mirror of users after three feeds that overlap, one of them applied twice."""
    feed = _feed(c)
    top = feed.agg(F.max("seq")).first()[0] or 0
    mirror = Mirror(c.spark, _new_folder(c, "mirror"), _MIRROR)
    for low, high in ((0, top // 3), (top // 4, top // 2), (top // 4, top // 2), (top // 3, top)):
        mirror.merge(feed.where(F.col("seq").between(low, high)))
    return mirror.rows().select("key", "seq", "event_type", "value")


_FACETS = SearchRequest(in_force=True, date_from="1993-01-01")


@query(
    "search_facets",
    with_tables("works", "work_types", "work_subjects")
    + """, h AS (SELECT * FROM works WHERE celex IS NOT NULL AND in_force AND doc_date >= DATE '1993-01-01'),
p AS (SELECT DISTINCT work_uri, 'type' AS facet, type_uri AS value FROM h JOIN work_types USING (work_uri) UNION ALL SELECT DISTINCT work_uri, 'year', CAST(year(doc_date) AS VARCHAR) FROM h
  UNION ALL SELECT DISTINCT work_uri, 'subject', concept_uri FROM h JOIN work_subjects USING (work_uri))
SELECT facet, value, count(DISTINCT work_uri) AS n_works, true AS sketch_is_close FROM p GROUP BY GROUPING SETS ((facet, value), (facet), ())""",
)
def _(c: Corpus) -> DataFrame:
    found = facets.facets(c, _FACETS)
    return found.select("facet", "value", "n_works", facets.close(F.col("n_works"), F.col("n_about")).alias("sketch_is_close"))


@query(
    "user_sessions",
    """WITH e AS (SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 8 HOUR, true) AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM e)
SELECT min(ts) AS session_start, max(ts) AS session_end, user_id, count(*) AS n, sum(value) AS total, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM s GROUP BY user_id, session""",
)
def _(c: Corpus) -> DataFrame:
    return sessions(c["events"])


@query("service_works", with_tables("works") + " SELECT work_uri, celex, doc_date, in_force FROM works WHERE in_force AND doc_date >= DATE '1994-01-01' AND celex IN (SELECT celex FROM works WHERE celex LIKE '3%')")
def _(c: Corpus) -> DataFrame:
    """Works as pages of a service, read back through the data source; the first two filters go along with the request."""
    folder = _new_folder(c, "service")
    service.store_pages(c["works"].select("work_uri", "celex", "doc_date", "in_force"), folder, "works")
    works = service.read(c.spark, folder, "works", "work_uri string, celex string, doc_date date, in_force boolean")
    return works.where((F.col("in_force") == F.lit(True)) & (F.col("doc_date") >= F.lit("1994-01-01").cast("date")) & F.startswith("celex", F.lit("3")))


@query("adhoc_outline", ORACLE_SQL["outline_offsets"])
def _(c: Corpus) -> DataFrame:
    """Outlines by an ad-hoc statement that calls the table function for each act."""
    bodies = "SELECT doc_id, array_join(transform(array_sort(collect_list(struct(line_no, line))), x -> x.line), '\\n') AS body FROM act_lines GROUP BY doc_id"
    return adhoc.select(c, f"SELECT b.doc_id, h.* FROM ({bodies}) b, LATERAL outline(b.body) h", ceiling=2**31 - 1).df


@query("adhoc_part_urls", ORACLE_SQL["multipart_urls"])
def _(c: Corpus) -> DataFrame:
    """The part addresses of indexes, by an ad-hoc statement over the parts."""
    link = """concat('<li><a href="/resource/', doc, '/', CASE WHEN seq % 4 = 3 THEN concat('x', seq) ELSE concat('DOC_', seq, '?a=1&amp;b=2') END, '">part</a></li>')"""
    index = f"SELECT doc, array_join(transform(sort_array(collect_set(struct(seq, {link} AS a)), false), x -> x.a), '') AS index FROM parts GROUP BY doc"
    statement = f"SELECT doc, array_join(transform(array_sort(collect_list(struct(position, url))), x -> x.url), ' ') AS urls FROM (SELECT i.doc, u.* FROM ({index}) i, LATERAL part_urls(i.index) u) GROUP BY doc"
    return adhoc.select(c, statement, ceiling=2**31 - 1).df
