"""Indexes, graphs, versions by date, mirrors and sessions against plain readings."""

import json
import math
import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nomograph.functions import tables
from nomograph.operators import document, facets, fulltext, graph, relations, search, structure, temporal
from nomograph.plans.requests import CaseRequest, SearchRequest
from nomograph.sources.corpus import Corpus
from nomograph.sources.mirror import Mirror
from nomograph.streaming.sessions import late_rows, sessions
from tests.conftest import DATA

WORDS = "law of the court and data été protection Règlement B2B x".split()


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


# --- phrases ---


def test_phrases_as_a_scan_finds_them(spark, tmp_path):
    r = random.Random(1)
    texts = [(f"k{r.randint(0, 80)}", r.choice(["", "  ", ", "]).join(["", " ".join(r.choice(WORDS) + r.choice(["", ",", ".", " -", "#"]) for _ in range(r.randint(1, 12))), ""])) for _ in range(300)]
    texts += [(None, "the court"), ("k900", None), ("k901", ""), ("k902", "--"), ("k903", "the the the court the")] + texts[:9]
    df = spark.createDataFrame(texts, "key string, text string")
    index = fulltext.PhraseIndex.build(df, str(tmp_path / "i"))
    for phrase in ["the court", "THE: Court!", "of", "the the", "law of the", "the the court the", "court nowhere", "data été", "", "!!", "b2b x", "the court and data"]:
        want = tokens(phrase)
        fit = lambda t, want=want: want and any(tokens(t)[i : i + len(want)] == want for i in range(len(tokens(t))))
        expected = {k for k, t in texts if k is not None and t is not None and fit(t)}
        assert {x.key for x in index.keys(phrase).collect()} == expected, phrase
    plan = index.keys("the court")._jdf.queryExecution().executedPlan().toString()
    assert "In(word, [court,the])" in plan and "bucket" in plan and "/texts" not in plan
    assert fulltext.PhraseIndex.build(df.limit(0), str(tmp_path / "none")).keys("the court").count() == 0


def test_searches_are_the_same_with_an_index(spark, tmp_path):
    plain, indexed = Corpus(spark, DATA), Corpus(spark, DATA)
    titles = search.english(plain).select(F.col("work_uri").alias("key"), F.col("title").alias("text"))
    indexed.titles = fulltext.PhraseIndex.build(titles, str(tmp_path / "i"))
    for find, request in ((search.search_documents, SearchRequest(keyword="gear", limit=100)), (search.search_documents, SearchRequest(keyword="R00", in_force=True, limit=100)), (search.search_cases, CaseRequest(keyword="opinion of brand", limit=100))):
        rows = find(indexed, request).collect()
        assert rows and sorted(rows, key=str) == sorted(find(plain, request).collect(), key=str)


# --- ranked search ---


def bm25(texts, query):
    docs = {i: tokens(t) for i, t in texts if t and tokens(t)}
    mean = sum(map(len, docs.values())) / len(docs)
    df = Counter(w for d in docs.values() for w in set(d))
    scores = defaultdict(float)
    for w, times in sorted(Counter(tokens(query)).items()):
        for i, d in docs.items():
            if tf := d.count(w):
                scores[i] += times * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return sorted(((-round(s, 9), i) for i, s in scores.items()))


@pytest.mark.parametrize(("block", "shard"), [(128, 65_536), (3, 40)])
def test_ranked_search_against_all_scores(spark, tmp_path, monkeypatch, block, shard):
    monkeypatch.setattr(fulltext, "BLOCK", block)
    monkeypatch.setattr(fulltext, "SHARD", shard)
    r = random.Random(2)
    texts = [(i * 7 - 300, " ".join(r.choice(WORDS[: r.randint(1, len(WORDS))]) for _ in range(r.randint(0, 30)))) for i in range(260)] + [(9000, None), (9001, "  "), (9002, "law " * 3000), (2**40, "court")]
    index = fulltext.RankedIndex.build(spark.createDataFrame(texts, "id long, text string"), str(tmp_path / "i"))
    asked = {"a": "law", "b": "the court", "c": "été protection data", "d": "nowhere", "e": "Court court of", "f": "", "g": "x"}
    got = defaultdict(list)
    for row in index.search(spark.createDataFrame(list(asked.items()), "query string, text string"), 7).orderBy("query", "rank").collect():
        got[row.query].append((-round(row.score, 9), row.id))
    for q, text in asked.items():
        assert [i for _, i in got[q]] == [i for _, i in bm25(texts, text)[:7]], q
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in bm25(texts, text)[:7]], atol=2e-9)


@pytest.mark.parametrize("together", [1, 50, 1 << 20])
def test_words_are_counted_where_texts_are_read(monkeypatch, together):
    """A row for each word of the texts read together, not for each word of each text; postings are whole and in order."""
    monkeypatch.setattr(fulltext, "TOGETHER", together)
    r = random.Random(5)
    texts = {k: [r.choice("abcdefé") for _ in range(r.randint(1, 30))] for k in r.sample(range(10**12), 200)}
    ids = list(texts)
    batches = [pa.RecordBatch.from_pydict({"id": pa.array(part, pa.int64()), "shard": pa.array([k % 3 for k in part], pa.int32()), "w": pa.array([texts[k] for k in part], pa.list_(pa.string()))}) for part in (ids[:70], ids[70:71], [], ids[71:])]
    rows = pa.Table.from_batches(list(fulltext._counted(iter(batches))))
    if together == 1 << 20:
        assert len(rows) == 3 * 7
    rows = rows.append_column("bucket", pa.array([0] * len(rows), pa.int32())).sort_by([("shard", "ascending"), ("word", "ascending")])
    got = {}
    for row in (x for b in fulltext._blocks(iter(rows.to_batches(max_chunksize=4)), 9.0) for x in b.to_pylist()):
        found = fulltext.unpacked(row["packed"], row["n"], row["low"])
        assert found[0].tolist() == sorted(found[0].tolist()) and found[0][-1] == row["high"] and all(k % 3 == row["shard"] for k in found[0].tolist())
        got |= {(row["word"], k): (tf, dl) for k, tf, dl in zip(*[x.tolist() for x in found], strict=True)}
    assert got == {(w, k): (text.count(w), len(text)) for k, text in texts.items() for w in text}


@pytest.mark.parametrize("text, n", [("", 0), ("  ", 0), ("Été-2 x\u00a0y", 4), ("İß\u0307a \u3000b_c!", 4), (None, None)])
def test_words_are_counted_as_they_are_found(spark, text, n):
    row = spark.createDataFrame([(text,)], "text string").select(F.regexp_count("text", F.lit(fulltext.WORD)), F.size(fulltext.words(F.col("text")))).first()
    assert row[0] == n and (text is None or row[1] == n)


def test_blocks_are_packed_small_and_skipped(spark, tmp_path):
    ids, tf, dl = np.array([5, 9, 300, 70_000]), np.array([1, 2, 300, 1]), np.array([4, 8, 1000, 3])
    (data,) = fulltext._packed(ids, tf, dl, np.array([0]), np.array([4]))
    assert len(data) < 40 and all((a == b).all() for a, b in zip(fulltext.unpacked(data, 4, 5), (ids, tf, dl), strict=True))
    # one rare text holds both words: blocks of the frequent word elsewhere stay closed
    texts = [(i, "the " * (1 + i % 3) + "law") for i in range(4000)] + [(5000, "the unicorn " * 5)]
    index = fulltext.RankedIndex.build(spark.createDataFrame(texts, "id long, text string"), str(tmp_path / "i"))
    blocks = index.blocks.where("word IN ('the', 'unicorn')").toArrow().sort_by([("word", "ascending"), ("low", "ascending")])
    worth = [1e-4 if w == "the" else 8.0 for w in blocks["word"].to_pylist()]
    lists = fulltext.Lists(blocks.append_column("worth", [worth]), index.mean)
    found, _, opened = fulltext.best_of(lists, 1)
    assert list(found) == [5000] and opened <= 2 < len(blocks)


# --- graphs ---


def reach(edges, source, hops=None):
    seen, frontier, n = {source: 0}, {source}, 0
    while frontier and (hops is None or n < hops):
        n += 1
        frontier = {b for a, b in edges if a in frontier} - set(seen)
        seen |= dict.fromkeys(frontier, n)
    return {(source, k, h) for k, h in seen.items() if h}


def test_closure_with_cycles_and_bounds(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 40), r.randint(0, 40)) for _ in range(70)] + [(1, 2), (2, 3), (3, 1), (5, 5), (None, 1), (1, None)] + [(100 + k, 101 + k) for k in range(12)]
    df, seeds = spark.createDataFrame(edges, "src int, dst int"), [1, 5, 7, 100, 999]
    whole = [(a, b) for a, b in edges if a is not None]
    for hops in (None, 1, 4):
        got = {tuple(x) for x in graph.closure(df, spark.createDataFrame([(s,) for s in [*seeds, 1]], "source int"), hops).collect()}
        assert {g for g in got if g[1] is not None} == set().union(*(reach([e for e in whole if e[1] is not None], s, hops) for s in seeds))


def test_rollup_in_log_many_rounds(spark):
    """A chain of 10,000 concepts: every one has the works of its end."""
    n = 10_000
    chain = spark.range(n - 1).select(F.col("id").cast("string").alias("concept_uri"), (F.col("id") + 1).cast("string").alias("broader_uri"))
    rounds = []
    found = graph.ancestors(chain, spark.createDataFrame([("0",), ("9000",)], "concept_uri string"), rounds)
    assert found.count() == n + n - 9000 and len(rounds) <= math.ceil(math.log2(n)) + 2


def test_rollup_counts_each_work_once(spark):
    t = spark.createDataFrame
    given = Corpus(
        spark,
        work_subjects=t([("w1", "a"), ("w1", "b"), ("w2", "b"), ("w2", "b"), ("w3", "c"), ("w4", "x"), ("w4", "y")], "work_uri string, concept_uri string"),
        concept_broader=t([("a", "top"), ("b", "top"), ("b", "c"), ("c", "top"), ("x", "y"), ("y", "x")], "concept_uri string, broader_uri string"),
        concepts=t([(c,) for c in ("a", "b", "c", "top", "x", "y", "none")], "concept_uri string"),
    )
    assert {tuple(r) for r in graph.rolled_up(given).collect()} == {("a", 1, 1), ("b", 2, 2), ("c", 1, 3), ("top", 0, 3), ("x", 1, 1), ("y", 1, 1), ("none", 0, 0)}


# --- versions by date ---


def test_versions_as_of_a_date(spark):
    r, day = random.Random(4), lambda n: date(2000, 1, 1) + timedelta(n)
    versions = sorted({(f"a{r.randint(0, 9)}", day(r.randint(0, 400))) for _ in range(40)})
    versions = [(a, d, f"v{k}") for k, (a, d) in enumerate(versions)]
    asked = [(k, r.choice([None, *(f"a{i}" for i in range(11))]), r.choice([None, day(r.randint(-20, 420))])) for k in range(500)] + [(900 + k, "a1", day(77)) for k in range(300)]
    got = temporal.as_of(spark.createDataFrame(asked, "id int, act string, date date"), spark.createDataFrame(versions, "act string, from_date date, version string")).collect()
    assert len(got) == len(asked)
    for row in got:
        own = max(((d, v) for a, d, v in versions if a == row.act and row.date is not None and d <= row.date), default=(None, None))
        assert (row.from_date, row.version) == own


@pytest.mark.parametrize("days", [1, 7, 64])
def test_dates_within_intervals(spark, monkeypatch, days):
    monkeypatch.setattr(temporal, "DAYS", days)
    r, day = random.Random(5), lambda n: date(2000, 1, 1) + timedelta(n)
    intervals = [(k, day(a := r.randint(-50, 300)), r.choice([None, day(a + r.choice([-3, 0, 1, 5, 200]))])) for k in range(60)]
    dates = [(k, day(r.randint(-60, 320))) for k in range(120)]
    found = temporal.within(spark.createDataFrame(intervals, "i int, from_date date, to_date date"), spark.createDataFrame(dates, "d int, date date"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted((x.i, x.d) for x in found.collect()) == sorted((i, d) for i, a, b in intervals for d, x in dates if a <= x and (b is None or x < b))


# --- mirrors ---


def test_feeds_in_any_cut_give_the_same_table(spark, tmp_path):
    r = random.Random(6)
    changes = [(f"k{r.randint(0, 60)}", n, r.random() < 0.3, r.randint(0, 9)) for n in range(400)] + [(None, 400, False, 1)]
    feed = spark.createDataFrame(changes, "key string, seq long, deleted boolean, x int")
    last = {k: (s, d, x) for k, s, d, x in changes if k is not None}
    expected = {(k, s, x) for k, (s, d, x) in last.items() if not d}
    for name, cuts in (("one", [400]), ("two", [120, 400]), ("more", [10, 11, 333, 400])):
        mirror, at = Mirror(spark, str(tmp_path / name), "x int"), 0
        for to in cuts:
            mirror.merge(feed.where((F.col("seq") >= at) & (F.col("seq") <= to)))
            at = max(0, to - 30)  # feeds overlap
        assert {tuple(x) for x in mirror.rows().collect()} == expected and mirror.mark()["seq"] == max(s for s, _, _ in last.values())
        before = mirror.mark()
        assert mirror.merge(feed) == before  # nothing new


def test_a_merge_that_dies_before_its_mark_changes_nothing(spark, tmp_path, monkeypatch):
    mirror = Mirror(spark, str(tmp_path / "m"), "x int")
    t = lambda rows: spark.createDataFrame(rows, "key string, seq long, deleted boolean, x int")
    mirror.merge(t([("a", 1, False, 1), ("b", 2, False, 2)]))
    with monkeypatch.context() as patch:
        patch.setattr(Mirror, "_set_mark", lambda self, mark: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            mirror.merge(t([("a", 3, True, None), ("c", 4, False, 4)]))
    assert {tuple(r) for r in mirror.rows().collect()} == {("a", 1, 1), ("b", 2, 2)}
    mirror.merge(t([("a", 3, True, None), ("c", 4, False, 4)]))
    assert {tuple(r) for r in mirror.rows().collect()} == {("b", 2, 2), ("c", 4, 4)}
    assert {tuple(r)[0] for r in mirror.rows(tombstones=True).collect()} == {"a", "b", "c"}
    assert mirror.sweep() >= 1 and {tuple(r) for r in mirror.rows().collect()} == {("b", 2, 2), ("c", 4, 4)}
    assert json.loads((tmp_path / "m" / "mark.json").read_text())["seq"] == 4


# --- facets ---


def test_facets_and_their_sketches(spark):
    found = facets.facets(Corpus(spark, DATA), SearchRequest(in_force=True))
    rows = found.collect()
    assert all(abs(r.n_about - r.n_works) <= math.ceil(4 * facets.ERROR * r.n_works) for r in rows)
    whole = {(r.facet, r.value): r.n_works for r in rows}
    assert whole[None, None] >= whole["year", None] == sum(n for (f, v), n in whole.items() if f == "year" and v)
    assert whole["type", None] <= sum(n for (f, v), n in whole.items() if f == "type" and v)  # a work may have several
    # sketches of two searches put together are those of both at once
    parts = [facets.facets(Corpus(spark, DATA), SearchRequest(in_force=True, **d)) for d in ({"date_to": "1996-06-30"}, {"date_from": "1996-01-01"})]
    merged = {(r.facet, r.value): r.n_about for r in facets.merged(parts[0].unionByName(parts[1])).collect()}
    assert set(merged) == set(whole) and all(abs(merged[k] - n) <= math.ceil(4 * facets.ERROR * n) for k, n in whole.items())


def test_sketch_error_on_many_works(spark):
    r = spark.range(200_000).select(F.hll_sketch_estimate(F.hll_sketch_agg(F.col("id").cast("string"), facets.LG_K))).first()[0]
    assert abs(r - 200_000) <= 4 * facets.ERROR * 200_000


# --- sessions ---


def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def run(spark, source, out, checkpoint):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = sessions(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return late_rows(q)


def test_a_stream_gives_the_table_s_sessions_across_a_restart(spark, tmp_path):
    rows = sorted((tuple(r) for r in events(spark).select("event_id", "ts", "user_id", "event_type", "value").collect()), key=lambda r: r[1])
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    cuts = [rows[k * len(rows) // 4 : (k + 1) * len(rows) // 4] for k in range(4)]
    late = (10**9, rows[0][1], 7, "view", 1.0)
    end = [(10**9 + 1, rows[-1][1] + timedelta(days=30), -1, "view", 0.0)]
    again = cuts[1] + cuts[0][-3:]  # events that come twice
    dropped = 0
    for k, part in enumerate([cuts[0], again, cuts[2], [*cuts[3], late], end, [(10**9 + 2, rows[-1][1] + timedelta(days=60), -1, "view", 0.0)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        if k in (1, 5):  # a run, and another that goes on from its checkpoint
            dropped += run(spark, source, out, checkpoint)
    got = {tuple(r) for r in spark.read.parquet(out).where("user_id >= 0").collect()}
    table = spark.createDataFrame(rows, schema)
    assert {(*r[:4], round(r[4], 6), *r[5:]) for r in got} == {(*r[:4], round(r[4], 6), *r[5:]) for r in map(tuple, sessions(table).collect())}
    assert dropped >= 1


def test_sessions_touch(spark):
    at = lambda m: datetime(2020, 1, 1) + timedelta(minutes=m)
    rows = [(1, at(0), 1, "a", 1.0), (2, at(480), 1, "b", 2.0), (3, at(961), 1, "a", 4.0), (3, at(961), 1, "a", 4.0), (4, at(0), None, "c", None)]
    got = {(r.user_id, r.n, r.total, r.kinds) for r in sessions(spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")).collect()}
    assert got == {(1, 2, 3.0, "a,b"), (1, 1, 4.0, "a"), (None, 1, None, "c")}


def test_outline_function_keeps_bodies_in_their_rows(spark):
    """No window and no join carries a body along with each of its lines; long bodies, blank lines and other scripts give what the operator gives."""
    lines = ["", "(1) before é😀", "Article 1", "", " <b>Title</b> ", "CHAPTER iv", "Article 2a", "(2) after", "text &#233; &amp; more", "ANNEX II - On things", "SECTION 3", "x" * 201]
    bodies = [(k, "\n".join(lines[(i * k) % len(lines)] for i in range(n))) for k, n in ((1, 12), (5, 64), (7, 65), (11, 1000))] + [(20, ""), (21, "(1) no article"), (22, None), (23, "Article 9")]
    df = spark.createDataFrame(bodies, "doc_id int, body string")
    df.createOrReplaceTempView("bodies_of_outline")
    tables.register(spark)
    found = spark.sql("SELECT b.doc_id, h.* FROM bodies_of_outline b, LATERAL outline(b.body) h")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Exchange" not in plan
    mine, theirs = ([tuple(r) for r in x.collect()] for x in (found, structure.outline_lines(structure.lines_of(df))))
    assert len(mine) > 400 and sorted(mine, key=str) == sorted(theirs, key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facets_take_one_shuffle_of_works(spark):
    """Counts need no set of works for each value, and adaptive execution doesn't put the parts by work together."""
    plan = _plan(facets.facets(Corpus(spark, DATA), SearchRequest(in_force=True)))
    assert "Expand" not in plan and plan.count("Exchange") == 2 and plan.count("REPARTITION_BY_NUM") == 1


def test_facets_of_repeated_rows_and_missing_values(spark):
    works = spark.createDataFrame([("a", "1", date(2000, 1, 1)), ("a", "1", date(2000, 1, 1)), ("b", "2", None), ("c", None, date(2001, 1, 1))], "work_uri string, celex string, doc_date date").withColumn("in_force", F.lit(True))
    types = spark.createDataFrame([("a", "T"), ("a", "T"), ("b", None), ("c", "T"), (None, "T"), ("gone", "T")], "work_uri string, type_uri string")
    subjects = spark.createDataFrame([("a", "S"), ("a", "S"), ("a", "R")], "work_uri string, concept_uri string")
    got = {(r.facet, r.value, r.n_works, r.n_about) for r in facets.facets(Corpus(spark, works=works, work_types=types, work_subjects=subjects), SearchRequest(in_force=True)).collect()}
    assert got == {("type", "T", 1, 1), ("type", None, 1, 1), ("type", None, 2, 2), ("year", "2000", 1, 1), ("year", None, 1, 1), ("subject", "S", 1, 1), ("subject", "R", 1, 1), ("subject", None, 1, 1), (None, None, 2, 2)}


def test_concepts_are_rolled_up_in_as_many_tasks_as_shuffles_have(spark):
    """What meets by concept, and by work, stays dealt: parts aren't put together by their packed size."""
    assert _plan(graph.rolled_up(Corpus(spark, DATA))).count("REPARTITION_BY_NUM") >= 4


def test_facts_of_works_are_made_sets_once(spark):
    c = Corpus(spark, DATA)
    assert "HashAggregate" not in _plan(document._facts(c))
    assert c.repeated("work_subjects").distinct().count() == c["work_subjects"].count() <= c.repeated("work_subjects").count()
    given = Corpus(spark, DATA, work_subjects=spark.createDataFrame([("a", "b")], "work_uri string, concept_uri string"))
    assert given.repeated("work_subjects").count() == 1


def test_edges_that_are_not_asked_for_are_not_made(spark):
    """Consolidated versions come from one kind of edges; the join that makes the others isn't run for them."""
    corpus = Corpus(spark, DATA)
    sources = corpus["works"].where("celex IS NOT NULL").select(F.col("work_uri").alias("source_uri"), F.col("celex").alias("source_celex"))
    plan = lambda types: relations.relation_rows(corpus, sources, types)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_partkey" not in plan(("consolidated_version",)) and "l_partkey" in plan(("legal_basis", "consolidated_version"))
    every = relations.relation_rows(corpus, sources).where("relation_type = 'consolidated_version'").drop("ordinal")
    alone = relations.relation_rows(corpus, sources, ("consolidated_version",)).drop("ordinal")
    assert alone.count() > 0 and sorted(map(str, every.collect())) == sorted(map(str, alone.collect()))
    assert relations.relation_rows(corpus, sources, ()).count() == 0
