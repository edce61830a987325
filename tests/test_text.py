import pytest
from pyspark.sql import functions as F

from nomograph.functions import dims, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


CASES = [
    (text.phrase, "  Data-protection: (GDPR)  ", "Data protection GDPR"),
    (text.phrase, "--", ""),
    (text.act_core, "32016R0679", "2016R0679"),
    (text.act_core, "02016R0679-20160504", "2016R0679"),
    (text.act_core, "x", None),
    (text.is_consolidated, "02016R0679-20160504", True),
    (text.is_consolidated, "32016R0679", False),
    (text.is_consolidated, None, False),
    (text.consolidation_date, "02009L0101-20131130", "2013-11-30"),
    (text.consolidation_date, "02009L0101-20130077", "2013-00-77"),
    (text.case_fragment, "C-131/12", "2012CJ0131"),
    (text.case_fragment, " t-22/20 ", "2020TJ0022"),
    (text.case_fragment, "C-6/64", "1964CJ0006"),
    (text.case_fragment, "C-12345/2001", "2001CJ12345"),
    (text.case_fragment, "C-1/999", "999CJ0001"),
    (text.case_fragment, "F-1/05", None),
    (text.identifier_kind, "32016R0679", "celex"),
    (text.identifier_kind, "02016R0679-20160504", None),
    (text.identifier_kind, "http://data.europa.eu/eli/reg/2016/679", "eli"),
    (text.bare_eli, "http://data.europa.eu/eli/reg/2016/679/", True),
    (text.bare_eli, "http://data.europa.eu/eli/reg/2016/679/oj", False),
    (text.eli_candidates, "http://data.europa.eu/eli/reg/2016/679/", ["http://data.europa.eu/eli/reg/2016/679/", "http://data.europa.eu/eli/reg/2016/679/oj"]),
    (text.safe_iri, "http://a/b", True),
    (text.safe_iri, "http://a/<b", False),
    (text.lexical_boolean, "1", True),
    (text.lexical_boolean, "false", False),
    (text.lexical_boolean, "yes", None),
    (text.roman, "XIV", 14),
    (text.roman, "IC", 99),
    (text.roman, "ABC", None),
    (text.roman, "C", 100),
    (text.decoded, "a&amp;lt;b &#8364;&nbsp;&GT;", "a<b € >"),
    (text.decoded, "&#128512;x", "😀x"),
    (text.strip, "\t\u00a0\u2003 a b\u3000\n\ufeff", "a b"),
    (text.strip, " \n\u2028 ", ""),
    (text.strip, "\n" * 50_000 + "x" + " \n" * 50_000 + "y", "x" + " \n" * 50_000 + "y"),
    (text.visible, "<p> a <b>b</b>  c</p>", "a b c"),
    (dims.type_label, dims.TYPE + "REG", "Regulation"),
    (dims.type_label, dims.TYPE + "NEW_TYPE", "NEW_TYPE"),
    (dims.body_label, dims.BODY + "EMEA", "European Medicines Agency"),
]


@pytest.mark.parametrize("f, value, wanted", CASES)
def test_function(spark, f, value, wanted):
    assert one(spark, value, f) == wanted


TITLES = [
    ("Ruling of a chamber.#North Mills v Harbour Board.#Salt – Duties.#Case T-8/03 R.", ("Case T-8/03 R.", "North Mills v Harbour Board.", "North Mills v Harbour Board.", "Salt – Duties.")),
    ("Ruling.#Ash v Birch.#Sent by a court of appeal.#Wool – Weights.#Cases C-5/07 and C-6/07.", ("Cases C-5/07 and C-6/07.", "Ash v Birch.", "Ash v Birch.", "Wool – Weights.")),
    ("View of the Advocate General.###", (None, "View of the Advocate General.", None, None)),
    ("Order.#Ash v Birch.#Wool.", (None, "Ash v Birch.", "Ash v Birch.", "Wool.")),
    ("Order.#Ash v Birch.", (None, "Ash v Birch.", "Ash v Birch.", None)),
    ("Ruling.#13#1", (None, "13", "13", "1")),
    ("Ruling.#\u00a0Ash\t#\u3000Wool\n", (None, "Ash", "Ash", "Wool")),
    ("###", (None, None, None, None)),
    ("Plain title", None),
    ("", None),
]


@pytest.mark.parametrize("title, wanted", TITLES)
def test_case_title(spark, title, wanted):
    found = one(spark, title, text.case_title)
    assert (tuple(found) if found else None) == wanted


@pytest.mark.parametrize("a, b, wanted", [("XIV", "14", True), ("I", "1", True), ("C", "100", True), ("7A", "7A", True), ("7A", "7", False), ("X", "11", False)])
def test_same_number(spark, a, b, wanted):
    assert spark.range(1).select(text.same_number(F.lit(a), F.lit(b))).first()[0] is wanted


def test_type_labels(spark):
    uris = [dims.TYPE + c for c in ("OPIN_AG", "AG_OPI", "ORDER", "CORRIGENDUM")]
    assert one(spark, uris, dims.type_labels, "array<string>") == "AG Opinion, CORRIGENDUM, Order"
    assert one(spark, [], dims.type_labels, "array<string>") is None


def test_term(spark):
    lit = lambda x: F.lit(x).cast("string")
    term = lambda *a: spark.range(1).select(text.term(*map(lit, a))).first()[0]
    assert term("uri", "http://a", None, None) == "<http://a>"
    assert term("bnode", "b0", None, None) == "_:b0"
    assert term("literal", 'a"b\\', None, "en") == '"a\\"b\\\\"@en'
    assert term("literal", "1", "http://www.w3.org/2001/XMLSchema#int", None) == '"1"^^xsd:int'
    assert term("literal", "1", "http://other", None) == '"1"^^<http://other>'
