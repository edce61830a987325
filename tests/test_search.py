import datetime as dt

import pytest

from nomograph.functions import dims
from nomograph.operators import document, identify, relations, search, subjects
from nomograph.plans.errors import RequestError
from nomograph.plans.requests import CaseRequest, DocumentRequest, SearchRequest
from nomograph.sources.corpus import Corpus

D = dt.date
ENG, FRA = dims.ENGLISH, dims.AUTHORITY + "/language/FRA"
W = "http://w/"


@pytest.fixture(scope="module")
def corpus(spark):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    works = [
        (W + "1", "32016R0679", D(2016, 4, 27), True, dims.ELI + "reg/2016/679/oj"),
        (W + "2", "32016R0679", D(2016, 4, 27), None, None),  # the same CELEX, no title
        (W + "3", "02016R0679-20160504", D(2016, 5, 4), None, None),
        (W + "4", "01995L0046-20180525", D(2018, 5, 25), None, None),  # of another act
        (W + "5", None, D(2020, 1, 1), None, None),
        (W + "6", "62012CJ0131", D(2014, 5, 13), None, None),
        (W + "7", "62012CJ0131_RES", D(2014, 5, 14), None, None),
        (W + "8", "62013TJ0001", None, None, None),
        (W + "9", "02016R0679-20200101", D(2020, 1, 1), None, None),
    ]
    types = [(W + "1", "REG"), (W + "2", "CORRIGENDUM"), (W + "2", "REG"), (W + "3", "CONS_TEXT"), (W + "4", "CONS_TEXT"), (W + "6", "JUDG"), (W + "7", "ABSTRACT_JUR"), (W + "9", "CONS_TEXT")]
    expressions = [("e1", W + "1", ENG, "General Data Protection Regulation"), ("e2", W + "1", FRA, "Règlement général"), ("e3", W + "6", ENG, "Judgment of the Court.#Spain SL v AEPD.#Words – more.#Case C-131/12.")]
    edges = [(W + "3", "consolidates", W + "1"), (W + "9", "consolidates", W + "1"), (W + "4", "consolidates", W + "1"), (W + "5", "consolidates", W + "1"), (W + "6", "cites", W + "1"), (W + "1", "cites", W + "6"), (W + "1", "cites", W + "6"), (W + "1", "based", W + "5")]
    predicate = {"consolidates": "act_consolidated_consolidates_resource_legal", "cites": "work_cites_work", "based": "resource_legal_based_on_resource_legal"}
    return Corpus(
        spark,
        works=t(works, "work_uri string, celex string, doc_date date, in_force boolean, eli string"),
        work_types=t([(w, dims.TYPE + x) for w, x in types], "work_uri string, type_uri string"),
        expressions=t(expressions, "expr_uri string, work_uri string, language_uri string, title string"),
        work_subjects=t([(W + "1", dims.CONCEPT + str(i)) for i in range(8)], "work_uri string, concept_uri string"),
        work_agents=t([(W + "1", dims.BODY + "EP"), (W + "1", dims.BODY + "EMA"), (W + "1", dims.BODY + "EMEA")], "work_uri string, agent_uri string"),
        agent_labels=t([(dims.BODY + "EP", "en", "European Parliament"), (dims.BODY + "EP", "fr", "Parlement européen")], "agent_uri string, lang string, label string"),
        edges=t([(s, predicate[p], o) for s, p, o in edges], "src_uri string, predicate string, dst_uri string"),
        concepts=t([(dims.CONCEPT + str(i),) for i in range(3)] + [("http://x/1",)], "concept_uri string"),
        concept_labels=t([(dims.CONCEPT + "0", "en", "Data protection"), (dims.CONCEPT + "1", "en", "data law"), (dims.CONCEPT + "1", "fr", "droit"), ("http://x/1", "en", "data"), (dims.CONCEPT + "2", "en", "law")], "concept_uri string, lang string, label string"),
        concept_notations=t([(dims.CONCEPT + "0", "b"), (dims.CONCEPT + "0", "a")], "concept_uri string, notation string"),
        concept_broader=t([(dims.CONCEPT + "0", dims.CONCEPT + "1"), (dims.CONCEPT + "0", dims.CONCEPT + "2")], "concept_uri string, broader_uri string"),
        contents=t([("32016R0679", "FR", "html", "text/html", 1, "fr " * 60), ("32016R0679", "EN", "html", "text/html", 1, "second " * 30), ("32016R0679", "EN", "html", "application/xhtml+xml", 1, "Article 1\nScope\n" + "text " * 40)], "celex string, language string, format string, media_type string, part_seq int, body string"),
    )


def celexes(df):
    return [r.celex_number for r in search.newest_first(df).collect()]


def test_works_of_one_celex_are_one_row(corpus):
    rows = search.search_documents(corpus, SearchRequest(keyword="0679", date_to="2016-05-03")).collect()
    assert [(r.work_uri, r.celex_number, r.resource_type, r.title, r.is_consolidated) for r in rows] == [(W + "1", "32016R0679", "CORRIGENDUM, Regulation", "General Data Protection Regulation", False)]


@pytest.mark.parametrize(
    "filters, wanted",
    [
        (dict(document_type="REG"), ["32016R0679"]),
        (dict(document_type="REG", include_consolidated=True), ["02016R0679-20200101", "01995L0046-20180525", "02016R0679-20160504", "32016R0679"]),
        (dict(in_force=True), ["32016R0679"]),
        (dict(keyword="data PROTECTION"), ["32016R0679"]),
        (dict(keyword="protection data"), []),
        (dict(keyword="règlement"), []),  # English titles only
        (dict(keyword="--cj"), []),
        (dict(concept=dims.CONCEPT + "3"), ["32016R0679"]),
        (dict(author="parliament"), ["32016R0679"]),
        (dict(author="parlement"), []),
        (dict(author="!!"), []),
        (dict(date_from="2018-05-25", date_to="2018-05-25"), ["01995L0046-20180525"]),
        (dict(keyword="6", date_to="2014-05-13", offset=0, limit=1), ["62012CJ0131"]),
    ],
)
def test_search(corpus, filters, wanted):
    assert celexes(search.search_documents(corpus, SearchRequest(**filters))) == wanted


def test_type_filter_limits_the_types_listed(corpus):
    assert search.search_documents(corpus, SearchRequest(document_type="REG")).first().resource_type == "Regulation"


@pytest.mark.parametrize(
    "filters, wanted",
    [
        ({}, ["62012CJ0131", "62013TJ0001"]),  # derivatives go, cases without a type stay
        (dict(include_derivative=True), ["62012CJ0131_RES", "62012CJ0131", "62013TJ0001"]),
        (dict(case_type="judgment"), ["62012CJ0131"]),
        (dict(case_number="c-131/12"), ["62012CJ0131"]),
        (dict(case_number="cj0131_r", include_derivative=True), ["62012CJ0131_RES"]),
        (dict(court="GC"), ["62013TJ0001"]),
        (dict(keyword="aepd"), ["62012CJ0131"]),
    ],
)
def test_cases(corpus, filters, wanted):
    assert celexes(search.search_cases(corpus, CaseRequest(**filters))) == wanted


def test_case_parts(corpus):
    row = search.search_cases(corpus, CaseRequest(case_type="judgment")).first()
    assert (row.display_title, row.parties, row.subject_matter, row.case_reference) == ("Spain SL v AEPD.", "Spain SL v AEPD.", "Words – more.", "Case C-131/12.")


def test_eager_failures(corpus):
    for filters, reason in (({}, "no_filters"), (dict(keyword="  "), "no_filters"), (dict(in_force=False), "no_filters"), (dict(include_consolidated=True), "no_filters"), (dict(keyword="absent"), "no_results"), (dict(date_from="2020-13-01"), "invalid_argument"), (dict(keyword="x", limit=101), "invalid_argument"), (dict(concept="ftp://x"), "invalid_argument")):
        with pytest.raises(RequestError) as e:
            search.find_documents(corpus, **filters)
        assert e.value.reason == reason
    page = search.find_documents(corpus, document_type="REG", limit=1)
    assert page.total == 1 and page.truncated and page.echo["document_type"] == "REG"


def test_lookup(corpus):
    hit = identify.lookup(corpus, " 32016R0679 ")
    assert (hit.found, hit.work_uri, hit.celex_number, hit.date) == (True, W + "1", "32016R0679", D(2016, 4, 27))
    assert identify.lookup(corpus, dims.ELI + "reg/2016/679").celex_number == "32016R0679"
    assert not identify.lookup(corpus, dims.ELI + "reg/2016/679/2020-01-01").found
    assert not identify.lookup(corpus, "39999R0001").found
    assert identify.lookup(corpus, "02016R0679-20160504", "celex").found
    with pytest.raises(RequestError):
        identify.lookup(corpus, "02016R0679-20160504")


def test_subjects(corpus):
    page = subjects.find_subjects(corpus, keyword="DATA")
    assert [tuple(r) for r in page.rows] == [(dims.CONCEPT + "0", "Data protection", "a", "data law"), (dims.CONCEPT + "1", "data law", None, None)]
    with pytest.raises(RequestError):
        subjects.find_subjects(corpus, keyword="none")


def test_relations(corpus):
    page, empty = relations.find_relations(corpus, celex="32016R0679")
    found = [(r.relation_type, r.direction, r.related_work_uri) for r in page.rows]
    assert found == [("cites", "outgoing", W + "6"), ("cites", "incoming", W + "6"), ("legal_basis", "outgoing", W + "5"), ("consolidated_version", "incoming", W + "9"), ("consolidated_version", "incoming", W + "3")]
    assert "amends" in empty and "cites" not in empty and not page.truncated
    by_uri, _ = relations.find_relations(corpus, work_uri=W + "1", types=("consolidated_version",))
    assert [r.related_work_uri for r in by_uri.rows] == [W + "9", W + "4", W + "3"]  # without a CELEX, any act's
    small, _ = relations.find_relations(corpus, celex="32016R0679", types=("cites", "legal_basis"), limit=2)
    assert small.truncated  # two rows of one arm, counted before repetitions go
    with pytest.raises(RequestError):
        relations.find_relations(corpus, celex="39999R0001")
    with pytest.raises(RequestError):
        relations.find_relations(corpus, celex="62013TJ0001")
    assert relations.snapshot(corpus, "62013TJ0001").count() == 0


def test_arms_are_cut_before_the_shuffle(corpus):
    plan = relations.relations_of(corpus, relations.source_of(corpus, None, W + "1"), limit=2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_document(corpus):
    got = document.fetch_document(corpus, celex="32016R0679")
    assert got["author_institution"] == "European Medicines Agency" and got["author_institutions"] == ["European Medicines Agency", "European Parliament"]
    assert len(got["eurovoc_subjects"]) == 8 and got["legal_basis"] == [W + "5"] and got["in_force"] is True
    assert got["is_superseded"] and got["current_consolidated_celex"] == "02016R0679-20200101" and got["consolidated_as_of"] == "2020-01-01"
    assert got["content"].startswith("Article 1") and not got["has_more"]
    newest = document.fetch_document(corpus, eli=dims.ELI + "reg/2016/679", resolve="current_consolidated", content_mode="metadata_only")
    assert newest["celex_number"] == "02016R0679-20200101" and newest["requested_celex"] == "32016R0679" and "content" not in newest
    french = document.fetch_document(corpus, celex="32016R0679", language="de", outline=True)
    assert french["language"] == "EN" and "language_fallback" in french and french["outline"][0]["title"] == "Scope"
    picked = document.fetch_document(corpus, work_uri=W + "1", select={"articles": "1, 9"})
    assert picked["selection"] == {"requested": ["Article 1", "Article 9"], "matched": ["Article 1"], "missed": ["Article 9"]}
    parts, at = "", 0
    while True:
        part = document.fetch_document(corpus, celex="32016R0679", offset=at, limit=37)
        parts += part.get("content", "")
        at += part["content_chars_returned"]
        if not part["has_more"]:
            break
    assert parts == document.fetch_document(corpus, celex="32016R0679", content_mode="full")["content"]
    assert document.fetch_document(corpus, celex="32016R0679", offset=10_000)["content_chars_returned"] == 0
    assert document.fetch_document(corpus, celex="62012CJ0131")["content_available"] is False
    for bad in (dict(), dict(celex="x", eli="y")):
        with pytest.raises(RequestError):
            DocumentRequest(**bad)


def test_page_is_a_top_k(corpus):
    plan = search.search_documents(corpus, SearchRequest(document_type="REG"))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "CartesianProduct" not in plan
