import pytest
from pyspark.sql import functions as F

from nomograph.functions import dims
from nomograph.operators import adhoc, content, document, identify, render, search, structure, subjects
from nomograph.operators.markdown import to_markdown
from nomograph.plans.config import Settings
from nomograph.plans.errors import RECOVERY, RequestError
from nomograph.plans.paging import Page
from nomograph.queries import QUERIES
from nomograph.sources.corpus import Corpus
from nomograph.streaming.windows import event_counts
from tests.conftest import DATA

ACT = """<p>(1) whereas</p>
(2) and
CHAPTER I
General
<p>Article 1</p>
Scope
(1) a point
Article 2a
Article 3
long %s
SECTION 1
ANNEX II - Forms
end
""" % ("x" * 201)


def test_xml_outline_takes_whole_lines(spark, tmp_path):
    from nomograph.queries import QUERIES

    texts = {1: "short\n" + "long line " * 30 + "end", 2: "x" * 81 + "\n\n" + "é" * 500}
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.celex, r.number): r.title for r in QUERIES["xml_outline"](spark, str(tmp_path)).collect()}
    assert got == {(str(i), str(n)): " ".join(line.split()) or None for i, t in texts.items() for n, line in enumerate(t.split("\n"))}


def test_outline_of_a_body():
    found = structure.outline(ACT)
    assert [(h["label"], h["title"]) for h in found] == [("Recital 1", None), ("Recital 2", None), ("CHAPTER I", "General"), ("Article 1", "Scope"), ("Article 2A", None), ("Article 3", None), ("Section 1", None), ("ANNEX II", "Forms")]
    assert all(ACT[h["offset"] :].split("\n")[0] for h in found)
    assert structure.outline("Judgment\n(1) text") == [] and structure.outline("ANNEX\n(1) text")[0]["label"] == "ANNEX"


def test_outline_of_lines_is_the_same(spark):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(ACT.split("\n"))], "doc_id long, line_no int, line string")
    rows = [r.asDict() for r in structure.outline_lines(lines).orderBy("offset").collect()]
    assert [{k: r[k] for k in ("kind", "number", "label", "title", "offset")} for r in rows] == structure.outline(ACT)


def test_sections():
    heads = structure.outline(ACT)
    got = structure.select_sections(ACT, heads, {"articles": "article 2A, 9", "chapters": "1", "annexes": "2"})
    assert got["matched"] == ["CHAPTER I", "Article 2A", "ANNEX II"] and got["missed"] == ["Article 9"]
    assert got["text"].startswith("CHAPTER I") and got["text"].endswith("ANNEX II - Forms\nend")


def test_xml_outline():
    body = "<GR><NO.P>(1)</NO.P></GR><TI><P>CHAPTER IV</P></TI><STI><P>Rules</P></STI><TI.ART>Article 17</TI.ART>\n<STI.ART>Right &amp; duty</STI.ART><NO.P>(2)</NO.P><TI.ART>Article 18</TI.ART>"
    assert [(h["label"], h["title"]) for h in structure.outline(body, "xml")] == [("Recital 1", None), ("CHAPTER IV", "Rules"), ("Article 17", "Right & duty"), ("Article 18", None)]


def test_markdown():
    html = """<html><head><style>p{}</style></head><body><table><tr><td class="oj-hd-date">1.1.2020</td></tr></table><hr/>
    <h2>Title <i>x</i></h2><table><col width="4%"/><col width="96%"/><tbody><tr><td>(1)</td><td><p>Prose <a href="#n">1</a> and <a href="http://a">link</a></p>
    <table class="oj-table"><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2|3</td></tr></table></td></tr></tbody></table><p>a<br>b &amp; c</p><ol><li>one</li><li>two</li></ol></body></html>"""
    assert to_markdown(html) == "## Title _x_\n\n(1) Prose 1 and [link](http://a)\n\n| A | B |\n| --- | --- |\n| 1 | 2\\|3 |\n\na  \nb & c\n\n1. one\n2. two"
    assert to_markdown("<table><tr><td>(a)</td><td>x</td></tr></table>") == "(a)\n\nx"
    assert to_markdown(None) == "" and to_markdown("<script>x</script>") == ""
    assert "|" in to_markdown("<table><col width='30%'><tr><td>a</td><td>b</td></tr></table>")


def made_markdown(r, depth=0):
    """A random block as HTML, with the Markdown it must become, and whether it is a paragraph."""
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    words = lambda: " ".join(word() for _ in range(r.randint(1, 5)))
    a, b, kind = words(), words(), r.choice(["p", "p", "heading", "list", "data", "numbers", "chrome"] if depth < 2 else ["p"])
    if kind == "p":
        form = r.choice([("{a}  \n {b}", "{a} {b}"), ("<b>{a}</b> {b}", "**{a}** {b}"), ("<a href='http://x'>{a}</a> <em>{b}</em>", "[{a}](http://x) _{b}_"), ("{a} <a href='#f'>{b}</a>", "{a} {b}"), ("{a}<br>{b}", "{a}  \n{b}")])
        return f"<p>{form[0].format(a=a, b=b)}</p>", [("p", form[1].format(a=a, b=b))]
    if kind == "heading":
        n = r.randint(1, 6)
        return f"<h{n}>{a}</h{n}>", [("h", "#" * n + " " + a)]
    if kind == "list":
        ordered, items = r.random() < 0.5, [words() for _ in range(r.randint(1, 4))]
        return f"<{'ol' if ordered else 'ul'}>" + "".join(f"<li>{x}</li>" for x in items) + f"</{'ol' if ordered else 'ul'}>", [("l", "\n".join((f"{k}. " if ordered else "* ") + x for k, x in enumerate(items, 1)))]
    if kind == "data":
        rows = [[words() + " long" for _ in range(2)] for _ in range(r.randint(1, 3))]
        text = "\n".join(f"| {x} | {y} |" for x, y in [rows[0], ["---", "---"], *rows[1:]])
        return "<table>" + "".join(f"<tr><td>{x}</td><td>{y}</td></tr>" for x, y in rows) + "</table>", [("t", text)]
    if kind == "numbers":
        out, blocks = "", []
        for k in range(r.randint(1, 3)):
            inner = [made_markdown(r, depth + 1) for _ in range(r.randint(1, 2))]
            out += f"<tr><td>({k})</td><td>{''.join(h for h, _ in inner)}</td></tr>"
            found = [x for _, xs in inner for x in xs]
            if found and found[0][0] == "p":
                found[0] = ("p", f"({k}) {found[0][1]}")
            else:
                found.insert(0, ("p", f"({k})"))
            blocks += found
        return f"<table><colgroup><col width='5%'><col></colgroup><tbody>{out}</tbody></table>", blocks
    masthead = f"<table><tr><td><p class='oj-hd-ti'>{a}</p></td></tr></table>"  # one inside another table takes that with it
    return r.choice(["<script>x</script>", "<hr>", "<style>p</style>", *[masthead] * (depth == 0)]), []


def test_markdown_of_made_pages():
    import random

    r = random.Random(17)
    for _ in range(600):
        made = [made_markdown(r) for _ in range(r.randint(1, 6))]
        html = "<html><head><title>t</title></head><body>" + "\n".join(h for h, _ in made) + "</body></html>"
        assert to_markdown(html) == "\n\n".join(t for _, blocks in made for _, t in blocks), html


def test_markdown_of_hostile_pages():
    import time

    began = time.perf_counter()
    assert to_markdown("<div>" * 20_000 + "deep").endswith("deep")
    assert to_markdown("<b>" * 20_000 + "deep" + "</i>" * 20_000)
    assert "end" in to_markdown("<table><tr><td>" * 3_000 + "end")
    assert to_markdown("<a " * 5_000 + "x") is not None
    assert time.perf_counter() - began < 30


def test_xml_elements(spark):
    body = "<A><TI><P>Section 2 <HT>x</HT></P></TI><STI><P>On <HT>forms</HT></P></STI><TI.ART>Article 3a</TI.ART> <P>x</P><STI.ART>no title</STI.ART><TI><P>Other</P></TI><NO.P>(7)</NO.P><TI.ART>Article 4<STI.ART>"
    assert [(h["label"], h["number"], h["title"], body[h["offset"] :][:3]) for h in structure.outline(body, "xml")] == [("Section 2", "2", "On forms", "<TI"), ("Article 3a", "3A", None, "<TI")]
    assert structure.outline("no tags", "xml") == [] and structure.outline("", "xml") == []


def bodies(spark, rows):
    return spark.createDataFrame(rows, "celex string, language string, format string, media_type string, part_seq int, body string")


def test_representation_and_language(spark):
    long = "x" * 120
    table = bodies(
        spark,
        [
            ("1", "EN", "html", "text/html", 1, "a" + long), ("1", "EN", "html", "application/xhtml+xml", 1, "b" + long), ("1", "DE", "html", "application/xhtml+xml", 1, "short"), ("1", "DE", "html", "text/html", 1, "c" + long),
            ("2", "EN", "html", "text/html", 1, "e" + long), ("3", "FR", "html", "text/html", 1, "<script src='token.AWSWAF.com'>" + long), ("4", "XX", "html", "text/html", 1, long), ("5", "EN", "html", "text/html", 1, " \n\t\u00a0" * 200),
        ],
    )
    wanted = spark.createDataFrame([("1", "DE"), ("1", "EN"), ("2", "FR"), ("3", "FR"), ("4", "XX"), ("5", "EN")], "celex string, requested string")
    got = {(r.celex, r.requested): (r.available, r.language, r.fallback, r.content[:1]) for r in content.in_language(table, wanted).collect()}
    assert got == {("1", "DE"): (True, "DE", False, "c"), ("1", "EN"): (True, "EN", False, "b"), ("2", "FR"): (True, "EN", True, "e"), ("3", "FR"): (False, "FR", False, ""), ("4", "XX"): (False, "XX", False, ""), ("5", "EN"): (False, "EN", False, "")}
    with pytest.raises(RequestError):
        content.fetch(Corpus(spark, contents=table), "3", "FR")


def test_parts(spark):
    index = '<a href="/resource/a/DOC_10">x</a><a href="/resource/a/DOC_2?a=1&amp;b=2"/><a href="/resource/a/x"/><a href="/other"/><a href="/resource/a/DOC_10"/>'
    assert spark.range(1).select(content.part_urls(F.lit(index))).first()[0] == ["/resource/a/DOC_2?a=1&b=2", "/resource/a/DOC_10", "/resource/a/x"]
    parts = spark.createDataFrame([(1, 2, "<b/>"), (1, 1, '<?xml version="1.0"?>\n<a/>'), (2, 1, "<a/>"), (2, 2, None)], "doc int, seq int, body string")
    assert {r.doc: r.body for r in content.assemble(parts).collect()} == {1: "<documents>\n<a/>\n<b/>\n</documents>", 2: None}


def test_window_counts_code_points(spark):
    df = spark.createDataFrame([("a😀bc",)], "content string")
    row = content.window(df, offset=1, limit=2).first()
    assert (row.window, row.content_chars_total, row.has_more) == ("😀b", 4, True)
    assert content.window(df, offset=9, limit=2).first().content_chars_returned == 0


def test_adhoc(spark):
    corpus = Corpus(spark, DATA)
    got = adhoc.run(corpus, "SELECT type_uri, count(*) AS n FROM work_types GROUP BY type_uri ORDER BY n DESC", ceiling=3)
    assert got.variables == ["type_uri", "n"] and len(got.bindings) == 3 and got.truncated
    assert not adhoc.select(corpus, "SELECT * FROM works LIMIT 3").limit_enforced
    assert adhoc.select(corpus, "SELECT * FROM (SELECT * FROM works LIMIT 3)").limit_enforced
    assert adhoc.select(corpus, "/* c */ WITH a AS (SELECT 1 AS x) SELECT x FROM a UNION ALL SELECT 2").df.count() == 2
    assert adhoc.select(corpus, "SELECT celex FROM works WHERE EXISTS (SELECT 1 FROM edges WHERE src_uri = work_uri)").df.count() > 0
    for bad, reason in (("DROP TABLE works_x", "not_read_only"), ("INSERT INTO works VALUES (1)", "not_read_only"), ("SET spark.x.y = 1", "not_read_only"), ("DESCRIBE TABLE works", "not_read_only"), ("SELEC x FROM works", "query_error"), ("SELECT nothing FROM works", "query_error"), (f"SELECT * FROM parquet.`{DATA}/orders.parquet`", "query_error"), ("SELECT 1", "invalid_argument")):
        with pytest.raises(RequestError) as e:
            adhoc.select(corpus, bad)
        assert e.value.reason == reason and e.value.recovery == RECOVERY[reason]


def test_adhoc_refuses_calls_into_the_jvm(spark):
    corpus = Corpus(spark, DATA)
    for call in ("reflect('java.lang.System', 'setProperty', 'own.probe', '1')", "JAVA_METHOD('java.util.UUID', 'randomUUID')", "try_reflect('java.util.UUID', 'randomUUID')", "upper(concat(system.builtin.reflect('java.util.UUID', 'randomUUID'), 'x'))"):
        for statement in (f"SELECT {call}", f"SELECT 1 FROM works WHERE {call} = '1'", f"WITH a AS (SELECT {call} AS x) SELECT x FROM a", f"SELECT * FROM works WHERE celex IN (SELECT {call})", f"SELECT transform(array(1), x -> {call})", f"SELECT * FROM works ORDER BY {call}"):
            with pytest.raises(RequestError) as e:
                adhoc.select(corpus, statement)
            assert e.value.reason == "not_read_only", statement
    assert spark._jvm.java.lang.System.getProperty("own.probe") is None


@pytest.mark.parametrize(
    "statement",
    [
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'setProperty', 'nomograph.x', 'y') FROM works",
        "FROM works |> EXTEND IDENTIFIER('java_' || 'method')('java.lang.System', 'setProperty', 'nomograph.x', 'y') AS z",
        "FROM works |> SELECT `try_reflect`('java.lang.System', 'setProperty', 'nomograph.x', 'y') AS z",
        "SELECT system.builtin.reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y')",
        "SELECT (SELECT max(reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y')) FROM works) AS z",
        "SELECT transform(array(1), x -> java_method('java.lang.System', 'setProperty', 'nomograph.x', 'y')) AS z",
        "SELECT celex FROM works WHERE EXISTS (SELECT 1 FROM edges WHERE reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y') = src_uri)",
        "SELECT celex FROM works ORDER BY reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y')",
        "SELECT sum(1) OVER (PARTITION BY reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y')) AS z FROM works",
        "SELECT * FROM range(length(reflect('java.lang.System', 'setProperty', 'nomograph.x', 'y')))",
        "SELECT * FROM IDENTIFIER('wo' || 'rks')",
        "WITH a AS (SELECT IDENTIFIER('ce' || 'lex') FROM works) SELECT * FROM a",
        "EXECUTE IMMEDIATE 'SELECT reflect(1)'",
    ],
)
def test_adhoc_names_functions_plainly(spark, statement):
    with pytest.raises(RequestError) as e:
        adhoc.select(Corpus(spark, DATA), statement).df.collect()
    assert e.value.reason == "not_read_only"
    assert spark._jvm.java.lang.System.getProperty("nomograph.x") is None


def test_adhoc_pipes_and_functions(spark):
    corpus = Corpus(spark, DATA)
    assert adhoc.select(corpus, "FROM works |> WHERE celex IS NOT NULL |> EXTEND upper(celex) AS z |> LIMIT 3").df.count() == 3
    assert adhoc.select(corpus, "SELECT btrim(celex), url_encode(celex), transform(array(1), x -> x + 1), max(celex) OVER () FROM works LIMIT 3").df.count() == 3


def test_adhoc_calls_table_functions(spark):
    body = "(1) first &amp; &#233;\n\nCHAPTER iv\n<b>Rules</b>\nArticle 1a\nArticle 2\n" + "x" * 201 + "\n(2) no recital\nANNEX II - Forms"
    acts = spark.createDataFrame([(1, body), (2, body), (3, ""), (4, None), (5, "no heading")], "doc_id int, body string")
    given = Corpus(spark, works=spark.createDataFrame([(1, "x")], "n int, work_uri string"))
    given.given["works"] = acts
    got = adhoc.select(given, "SELECT w.doc_id, h.* FROM works w, LATERAL outline(w.body) h", ceiling=1000).df.orderBy("doc_id", "offset").collect()
    for doc in (1, 2):
        assert [r.asDict() | {"doc_id": None} for r in got if r.doc_id == doc] == [h | {"doc_id": None} for h in structure.outline(body)]
    assert {r.doc_id for r in got} == {1, 2} and len(structure.outline(body)) == 5
    with pytest.raises(RequestError) as e:
        adhoc.select(given, "SELECT * FROM python_worker_logs()")
    assert e.value.reason == "not_read_only"
    assert adhoc.select(given, "SELECT * FROM works w, LATERAL explode(split(w.body, ' ')) LIMIT 2").df.count() == 2


def test_adhoc_over_given_tables(spark):
    given = Corpus(spark, works=spark.createDataFrame([("w", "32001R0001")], "work_uri string, celex string"))
    assert [tuple(r) for r in adhoc.run(given, "SELECT work_uri, celex FROM works").bindings] == [("w", "32001R0001")]
    with pytest.raises(RequestError):
        adhoc.run(given, "SELECT * FROM edges")
    assert not spark.catalog.tableExists("works")


def test_adhoc_runs_out_of_time(spark):
    corpus = Corpus(spark, DATA, settings=Settings(timeout_ms=1000))
    slow = "SELECT sum(a.id * b.id % 7) AS s FROM range(0, 4000000, 1, 4) a JOIN range(0, 4000000, 1, 4) b ON a.id % 1000 = b.id % 1000"
    with pytest.raises(RequestError) as e:
        adhoc.run(corpus, slow)
    assert e.value.reason == "query_timeout" and adhoc.run(corpus, "SELECT 1 AS one, 2 AS two").bindings[0].one == 1


def test_settings_hold_and_calls_are_logged(spark, caplog):
    corpus = Corpus(spark, DATA, settings=Settings(row_ceiling=3, language="fr"))
    with caplog.at_level("INFO", logger="nomograph"):
        assert search.find_documents(corpus, in_force=True, limit=50).total == 3
        assert len(adhoc.run(corpus, "SELECT celex FROM works").bindings) == 3
        assert subjects.find_subjects(corpus, keyword="a").echo["language"] == "fr"
        with pytest.raises(RequestError):
            document.fetch_document(corpus, celex="none")
        assert identify.lookup(corpus, "31900R0001").found is False
    lines = [r.getMessage() for r in caplog.records]
    assert [next(n for n in ("find_documents", "adhoc", "find_subjects", "fetch_document", "lookup") if f"'call': '{n}'" in x) for x in lines] == ["find_documents", "adhoc", "find_subjects", "fetch_document", "lookup"]
    assert "'rows': 3" in lines[0] and "'failed': 'not_found'" in lines[3]
    for bad in (dict(row_ceiling=0), dict(row_ceiling=101), dict(timeout_ms=10), dict(language="?")):
        with pytest.raises(RequestError):
            Settings(**bad)


def test_rendering(spark):
    df = spark.createDataFrame([("A", 1, None)], "title string, n int, x string")
    assert render.records(df).first()[0] == '{"title":"A","n":1}'
    assert render.as_text(df, "title").first()[0] == "### A\n- **n:** 1"
    assert render.page_text(Page(df.collect(), truncated=True, cap=1), "title").endswith("there may be more.")


@pytest.mark.parametrize("focus, axis", [("Enforcement mechanisms", "enforcement"), ("latest cases", "recent_developments"), ("comparison", "key_differences"), ("data subject rights", None), ("duty of care", "core_obligations")])
def test_focus(spark, focus, axis):
    assert spark.range(1).select(render.focus_axis(F.lit(focus))).first()[0] == axis
    prompt = render.comparison_prompt("privacy", focus)
    assert (f"**{focus[0].upper()}{focus[1:]}**" in prompt) and prompt.count("\n6. ") == 1


def test_stream_and_table_agree(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("ts", "event_type", "value")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = event_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("counts").select("window_start", "event_type", "n").collect())) == sorted(map(tuple, event_counts(events).select("window_start", "event_type", "n").collect()))


def test_fetch_shuffles_windows_and_what_is_asked_for(spark):
    """Whole texts stay where they are read, and facts of fields that aren't asked for aren't read."""
    plan = QUERIES["document_fetch"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ranks = [line for line in plan if "row_number()" in line and "windowspecdefinition" in line]
    assert ranks and all("window#" in line and "body#" not in line for line in ranks)
    under = "\n".join(plan)
    assert "l_partkey" in under and dims.CONCEPT not in under and document.BASIS not in under


def fetch_tables(spark):
    eli = dims.ELI + "reg/2016/"
    works = [("w2", "32016R0002", eli + "2/oj"), ("w1", "32016R0001", eli + "1"), ("w3", "32016R0001", eli + "1/oj"), ("w4", None, eli + "4"), ("w0", "32016R0005", eli + "oj/oj"), ("v1", "02016R0001-20200101", None)]
    works = spark.createDataFrame(works, "work_uri string, celex string, eli string").withColumns({"doc_date": F.lit("2016-01-01").cast("date"), "in_force": F.lit(True)})
    titles = spark.createDataFrame([("w3", dims.ENGLISH, "third"), ("w2", dims.ENGLISH, "second")], "work_uri string, language_uri string, title string")
    agents = spark.createDataFrame([("w1", dims.BODY + "EP"), ("w3", dims.BODY + "COM"), ("w3", dims.BODY + "EP")], "work_uri string, agent_uri string")
    edges = spark.createDataFrame([("v1", "act_consolidated_consolidates_resource_legal", "w1")], "src_uri string, predicate string, dst_uri string")
    empty = {"work_types": "work_uri string, type_uri string", "work_subjects": "work_uri string, concept_uri string"}
    return {"works": works, "expressions": titles, "work_agents": agents, "edges": edges} | {n: spark.createDataFrame([], s) for n, s in empty.items()}


def test_fetch_of_many_ways_to_ask(spark):
    long, eli = "".join(chr(97 + i % 26) for i in range(150)), dims.ELI + "reg/2016/"
    table = bodies(spark, [("32016R0001", "EN", "html", "text/html", 1, "z" + long), ("32016R0001", "FR", "html", "text/html", 1, "y" + long), ("02016R0001-20200101", "EN", "html", "text/html", 1, "x" + long)])
    corpus = Corpus(spark, contents=table, **fetch_tables(spark))
    asks = [
        ("32016R0001", "celex", "FR", "as_requested"), ("32016R0001", "celex", "FR", "as_requested"), ("32016R0001", "celex", "DE", "current_consolidated"), (eli + "2", "eli", "EN", "as_requested"), (eli + "2/", "eli", "EN", "as_requested"),
        (eli + "1", "eli", None, "as_requested"), (eli + "oj", "eli", "EN", None), (eli + "4", "eli", "EN", "as_requested"), (" w3 ", "work_uri", "EN", "as_requested"), (None, "celex", "EN", "as_requested"), ("w2", None, "EN", "as_requested"),
    ]
    requests = spark.createDataFrame(asks, "identifier string, kind string, language string, resolve string")
    got = document.documents(corpus, requests, offset=1, limit=3, fields=("title", "author_institution"))
    shown = {(r.identifier, r.kind, r.requested_language, r.resolve): (r.celex_number, r.work_uri, r.title, r.author_institution, r.is_superseded, r.content, r.content_chars_total) for r in got.collect()}
    com, first = "European Commission", ("32016R0001", "w3", "third")
    assert got.count() == len(shown) == len(set(asks)) and shown == {
        asks[0]: (*first, com, True, "abc", 151), asks[2]: ("02016R0001-20200101", "v1", None, None, True, "abc", 151), asks[3]: ("32016R0002", "w2", "second", None, False, "", 0), asks[4]: ("32016R0002", "w2", "second", None, False, "", 0),
        asks[5]: (*first, com, True, "", 0), asks[6]: ("32016R0005", "w0", None, None, False, "", 0), asks[7]: (None, None, None, None, False, None, None), asks[8]: (*first, com, True, "abc", 151),
        asks[9]: (None, None, None, None, False, None, None), asks[10]: (None, None, None, None, False, None, None),
    }
    whole = document.documents(corpus, requests, offset=1, limit=3).where("identifier = '32016R0001' AND resolve = 'as_requested'").first()
    assert (whole.author_institution, whole.author_institutions, whole.eurovoc_subjects) == (com, [com, "European Parliament"], None)


def test_windows_of_bodies_that_only_their_text_tells_apart(spark):
    """The least text serves, though the windows are equal."""
    long = "a" * 120
    twins = bodies(spark, [("1", "EN", "html", "text/html", 1, long + "z"), ("1", "EN", "html", "text/html", 1, long + "bcd")])
    assert [(r.window, r.content_chars_total) for r in content.windows(twins, 0, 5).collect()] == [("aaaaa", 123)]
    apart = bodies(spark, [("1", "EN", "html", "text/html", 2, long + "z"), ("1", "EN", "html", "text/html", 1, "short"), ("1", "EN", "html", "text/html", 3, "awswaf" + long), ("1", "DE", "html", "text/html", 1, None)])
    assert [(r.part_seq, r.window, r.content_chars_total) for r in content.windows(apart, 119, 5).collect()] == [(2, "az", 121)]
    corpus = Corpus(spark, contents=twins, **(fetch_tables(spark) | {"works": spark.createDataFrame([("w", "1")], "work_uri string, celex string").withColumns({"eli": F.lit(None).cast("string"), "doc_date": F.lit(None).cast("date"), "in_force": F.lit(True)})}))
    asked = spark.createDataFrame([("1", "celex", "EN", "as_requested")], "identifier string, kind string, language string, resolve string")
    row = document.documents(corpus, asked, offset=0, limit=5).first()
    assert (row.content, row.content_chars_total, row.content_chars_returned, row.has_more) == ("aaaaa", 123, 5, True)
