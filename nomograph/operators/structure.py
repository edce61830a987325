"""The outline of acts: headings with their offsets, and the sections that a reader selects.

Everything is a plan of expressions and windows within each document, over tables of bodies; a single body is a table of
one row. Rendered text is read by lines, the XML notation by its tags. Offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.functions import text

# Nesting ranks and the forms of headings, which stand alone on a line.
RANKS = {"chapter": 1, "annex": 1, "section": 2, "article": 3, "recital": 4}
ARTICLE = r"^Article\s+(\d+[a-z]?)\s*$"
CHAPTER = r"(?i)^CHAPTER\s+([IVXLCDM]+|\d+)\s*$"
SECTION = r"(?i)^SECTION\s+([IVXLCDM]+|\d+)\s*$"
ANNEX = r"^ANNEX(?:\s+([IVXLCDM]+|\d+|[A-Z])(?=\s|$))?(?:\s*[-–—:.]\s*(.*))?\s*$"
RECITAL = r"^\((\d+)\)(?:\s|$)"
KINDS = (("article", ARTICLE), ("chapter", CHAPTER), ("section", SECTION), ("annex", ANNEX))
LABELS = {"article": "Article", "chapter": "CHAPTER", "section": "Section", "annex": "ANNEX", "recital": "Recital"}
#: A following line is a title up to this length.
LONGEST_TITLE = 200


def lines_of(bodies: DataFrame) -> DataFrame:
    """bodies: doc_id, body. doc_id, line_no, line of every line."""
    return bodies.select("doc_id", F.posexplode(F.split("body", "\n", -1)).alias("line_no", "line"))


def outline_lines(lines: DataFrame) -> DataFrame:
    """lines: doc_id, line_no, line. The headings of each document: kind, number, label, title and offset (in code points).

    A title is the first line with text after a heading, unless that is a heading or too long. Recitals count before
    the first article, chapter or section only, and not at all without one."""
    by_line = Window.partitionBy("doc_id").orderBy("line_no")
    seen = lines.select("doc_id", "line_no", text.visible(F.col("line")).alias("v"), F.length("line").alias("n"))
    seen = seen.withColumn("offset", F.coalesce(F.sum(F.col("n") + 1).over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        kind = F.when(F.col("v").rlike(pattern), name).otherwise(kind)
    seen = seen.withColumn("structural", kind)
    pattern = {name: F.upper(F.regexp_extract("v", p, 1)) for name, p in KINDS}
    number = F.coalesce(*[F.when(F.col("structural") == name, value) for name, value in pattern.items()])
    inline = F.when(F.col("structural") == "annex", F.nullif(F.trim(F.regexp_extract("v", ANNEX, 2)), F.lit("")))
    text_line = F.when(F.col("v") != "", F.struct("v", "structural"))
    after = F.first(text_line, ignorenulls=True).over(by_line.rowsBetween(1, Window.unboundedFollowing))
    seen = seen.withColumn("after", after)
    enacting = F.min(F.when(F.col("structural").isin("article", "chapter", "section"), F.col("offset"))).over(Window.partitionBy("doc_id"))
    seen = seen.withColumn("enacting", enacting)
    recital = F.col("structural").isNull() & F.col("v").rlike(RECITAL) & (F.col("offset") < F.col("enacting"))
    found = seen.where(F.col("structural").isNotNull() | recital)
    kind = F.coalesce("structural", F.lit("recital"))
    number = F.coalesce(number, F.regexp_extract("v", RECITAL, 1))
    following = F.when(F.col("after.structural").isNull() & (F.length("after.v") <= LONGEST_TITLE), F.col("after.v"))
    title = F.when(F.col("structural").isNotNull(), F.coalesce(inline, following))
    return found.select("doc_id", kind.alias("kind"), number.alias("number"), label(kind, number).alias("label"), title.alias("title"), "offset")


def label(kind: Column, number: Column) -> Column:
    words = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.when((kind == "annex") & (number == ""), "ANNEX").otherwise(F.concat_ws(" ", F.try_element_at(words, kind), number))


def sections(headings: DataFrame, requests: DataFrame) -> DataFrame:
    """headings of documents; requests: doc_id, ordinal, kind, token. For each request its first heading of an equal number, with the section's start and end; nulls for a miss. The end is the next heading of the same or a broader rank, null for the document's end."""
    rank = F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair])
    ranked = headings.withColumn("rank", F.try_element_at(rank, F.col("kind")))
    later = Window.partitionBy("doc_id").orderBy("offset").rowsBetween(1, Window.unboundedFollowing)
    ends = F.create_map(*[x for r in (1, 2, 3, 4) for x in (F.lit(r), F.min(F.when(F.col("rank") <= r, F.col("offset"))).over(later))])
    ranked = ranked.withColumn("end", F.try_element_at(ends, F.col("rank")))
    same = (F.col("h.doc_id") == F.col("r.doc_id")) & (F.col("h.kind") == F.col("r.kind"))
    hits = requests.alias("r").join(ranked.alias("h"), same).where(text.same_number(F.col("h.number"), F.col("r.token")))
    first = hits.groupBy("r.doc_id", "r.ordinal").agg(F.min(F.struct("h.offset", "h.label", "h.end")).alias("s"))
    return requests.join(first, ["doc_id", "ordinal"], "left").select("doc_id", "ordinal", "kind", "token", F.col("s.label").alias("matched"), F.col("s.offset").alias("start"), F.col("s.end").alias("end"))


#: Elements of the XML notation that make up headings: an article's name and its title, a division's name and its title, a recital's number.
ELEMENTS = ("TI.ART", "STI.ART", "TI", "STI", "NO.P")
DIVISION = r"(?i)^(CHAPTER|SECTION)\s+([IVXLCDM0-9]+)"
_TAG = r"</?[A-Za-z][^<>]*>"
_OPENS = r"(?i)^<(?:" + "|".join(e.replace(".", r"\.") for e in ELEMENTS) + ")>"
_ELEMENT = r"(?is)^<([^\s<>/]+)>.*?</\1>"


def elements_of(bodies: DataFrame) -> DataFrame:
    """bodies: doc_id, body. Every heading element that ends before the next one begins, in order: doc_id, i, name (in capitals), offset, v (its visible text), and touching, whether nothing but white space stands before the next.

    A body is cut where heading elements open; what lies between them is measured and let go of, so that windows sort rows of headings."""
    pieces = F.split("body", "(?=" + _OPENS.replace("^", "") + ")", -1)
    each = bodies.select("doc_id", F.posexplode(pieces).alias("i", "piece"))
    each = each.select("doc_id", "i", F.length("piece").alias("n"), F.when(F.col("piece").rlike(_OPENS), F.regexp_extract("piece", _ELEMENT, 0)).alias("element"), "piece")
    name = F.upper(F.regexp_extract("element", r"^<([^\s<>/]+)>", 1))
    inside = F.substring(F.col("element"), F.length("name") + 3, F.length("element") - 2 * F.length("name") - 5)
    each = each.withColumn("name", F.when(F.length("element") > 0, name))
    touching = text.strip(F.substring(F.col("piece"), F.length("element") + 1, F.length("piece"))) == ""
    # settled before the windows: an expression over a window's rows would carry the pieces through the sort
    each = each.select("doc_id", "i", "n", "name", F.when(F.col("name").isNotNull(), F.struct(text.visible(F.regexp_replace(inside, _TAG, " ")).alias("v"), touching.alias("touching"))).alias("e"))
    before = Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")).select("doc_id", "i", "name", "offset", "e.v", "e.touching")


def outline_xml(bodies: DataFrame) -> DataFrame:
    """bodies: doc_id, body. The headings of acts in XML, as outline_lines gives them. A title is the title element that stands right after the name; recitals count before the first article only; annexes have no element."""
    in_order = Window.partitionBy("doc_id").orderBy("i")
    following = F.lead(F.struct("name", "v")).over(in_order)
    article = F.col("name") == "TI.ART"
    first = F.min(F.when(article, F.col("offset"))).over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = elements_of(bodies).withColumn("next", F.when(F.col("touching"), following)).withColumn("first", F.coalesce(first, F.lit(2**62))).where(F.col("name").isNotNull())
    subtitle = F.when(F.col("next.name") == F.concat(F.lit("S"), F.col("name")), F.nullif(F.col("next.v"), F.lit("")))
    division = (F.col("name") == "TI") & F.col("v").rlike(DIVISION)
    recital = (F.col("name") == "NO.P") & F.col("v").rlike(r"^\(\d+\)$") & (F.col("offset") < F.col("first"))
    kind = F.when(article, "article").when(division, F.lower(F.regexp_extract("v", DIVISION, 1))).when(recital, "recital")
    number = F.when(article, F.upper(F.regexp_extract("v", r"\d+[a-z]?", 0))).when(division, F.upper(F.regexp_extract("v", DIVISION, 2))).otherwise(F.regexp_extract("v", r"\d+", 0))
    found = parts.select("doc_id", kind.alias("kind"), number.alias("number"), "v", subtitle.alias("title"), "offset").where(F.col("kind").isNotNull())
    own = F.when(F.col("kind") == "article", F.nullif(F.col("v"), F.lit("")))
    return found.select("doc_id", "kind", "number", F.coalesce(own, label(F.col("kind"), F.col("number"))).alias("label"), "title", "offset")


def headings_of(bodies: DataFrame, fmt: str = "html") -> DataFrame:
    """bodies: doc_id, body. The headings of each; none for a body without structure."""
    return outline_xml(bodies) if fmt == "xml" else outline_lines(lines_of(bodies))


OUTLINE = "array<struct<kind:string,number:string,label:string,title:string,offset:long>>"


def outlines(contents: DataFrame, fmt: str = "xml") -> DataFrame:
    """contents: celex, body, one row for each CELEX. The outline of each body as an array, empty without structure."""
    heads = headings_of(contents.select(F.col("celex").alias("doc_id"), "body"), fmt)
    listed = heads.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("offset", "kind", "number", "label", "title"))).alias("h"))
    ordered = F.transform("h", lambda x: F.struct(x["kind"].alias("kind"), x["number"].alias("number"), x["label"].alias("label"), x["title"].alias("title"), x["offset"].alias("offset")))
    return contents.select("celex").join(listed.select(F.col("doc_id").alias("celex"), ordered.alias("outline")), "celex", "left").select("celex", F.coalesce("outline", F.array().cast(OUTLINE)).alias("outline"))


SELECTORS = {"articles": "article", "chapters": "chapter", "recitals": "recital", "annexes": "annex"}


def tokens(selector: Column) -> Column:
    """The numbers that a selector lists between commas, with or without the kind's name, in capitals."""
    each = F.transform(F.split(F.coalesce(selector, F.lit("")), ","), lambda x: F.upper(F.regexp_replace(text.strip(x), r"(?i)^(article|chapter|section|annex|recital)\s+", "")))
    return F.filter(each, lambda x: x != "")


def asked(selectors: DataFrame) -> DataFrame:
    """selectors: doc_id, and by kind articles, chapters, recitals, annexes. The requests of each document in this order: doc_id, ordinal, kind, token."""
    both = [F.arrays_zip(F.transform(tokens(F.col(name)), lambda t: F.lit(kind)).alias("kind"), tokens(F.col(name)).alias("token")) for name, kind in SELECTORS.items()]  # noqa: B023  transform calls it at once
    return selectors.select("doc_id", F.posexplode(F.concat(*both)).alias("ordinal", "r")).select("doc_id", "ordinal", "r.kind", "r.token")


def selections(bodies: DataFrame, headings: DataFrame, requests: DataFrame) -> DataFrame:
    """bodies: doc_id, body; headings and requests as for sections. For each document with requests: requested, matched (labels in
    the document's order), missed, and the text of the matched sections in that order, each start once."""
    found = sections(headings, requests).withColumn("asked_for", label(F.col("kind"), F.col("token")))
    hit = F.when(F.col("start").isNotNull(), F.struct("start", "ordinal", "matched", "end"))
    lists = found.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "asked_for"))).alias("requested"),
        F.array_sort(F.collect_list(F.when(F.col("start").isNull(), F.struct("ordinal", "asked_for")))).alias("missed"),
        F.array_sort(F.collect_list(hit)).alias("hits"),
    )
    starts = F.array_distinct(F.transform("hits", lambda h: h["start"]))
    furthest = lambda a: F.array_max(F.transform(F.filter("hits", lambda h: h["start"] == a), lambda h: F.coalesce(h["end"].cast("long"), F.length("body").cast("long"))))
    part = lambda a: text.strip(F.substring(F.col("body"), (a + 1).cast("int"), (furthest(a) - a).cast("int")))
    names = lambda c: F.transform(c, lambda x: x["asked_for"])
    return lists.join(bodies, "doc_id").select(
        "doc_id", names("requested").alias("requested"), F.transform("hits", lambda h: h["matched"]).alias("matched"), names("missed").alias("missed"), F.array_join(F.transform(starts, part), "\n\n").alias("text")
    )


# Single bodies: tables of one row.


def _one(body: str) -> DataFrame:
    return SparkSession.active().createDataFrame([(0, body)], "doc_id int, body string")


def outline(body: str, fmt: str = "html") -> list[dict]:
    """A body's headings in order; empty if it has no structure."""
    return [r.asDict() for r in headings_of(_one(body), fmt).drop("doc_id").orderBy("offset").collect()]


def select_sections(body: str, headings: list[dict], selectors: dict[str, str]) -> dict[str, object]:
    """The selection from one body with these headings."""
    spark, one = SparkSession.active(), _one(body)
    heads = spark.createDataFrame([(0, h["kind"], h["number"], h["label"], h["title"], h["offset"]) for h in headings], "doc_id int, kind string, number string, label string, title string, offset long")
    wanted = asked(one.select("doc_id", *[F.lit(selectors.get(name)).cast("string").alias(name) for name in SELECTORS]))
    row = selections(one, heads, wanted).drop("doc_id").first()
    return row.asDict() if row else {"requested": [], "matched": [], "missed": [], "text": ""}
