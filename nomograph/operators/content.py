"""Document bodies: representation and language fallback, parts, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomograph.functions import text
from nomograph.functions.dims import LANGUAGES, MEDIA_TYPES
from nomograph.plans.errors import RequestError
from nomograph.plans.requests import WINDOW
from nomograph.sources.corpus import Corpus

#: Bodies shorter than this, trimmed, don't count.
LEAST_BODY = 100
# Text that marks a stored access challenge in a body's first HEAD characters.
CHALLENGES = ("awswaf", "gokuprops")
HEAD = 4096


def usable(body: Column) -> Column:
    return F.length(text.strip(body)) >= LEAST_BODY


def challenged(body: Column) -> Column:
    head = F.lower(F.substring(body, 1, HEAD))
    return F.contains(head, F.lit(CHALLENGES[0])) | F.contains(head, F.lit(CHALLENGES[1]))


def _usable(contents: DataFrame, fmt: str) -> tuple[DataFrame, Column]:
    """The bodies that may serve, and their media types' places in the order. Of windows() only such are left."""
    fmt = "html" if fmt == "markdown" else fmt
    priority = F.array_position(F.array(*map(F.lit, MEDIA_TYPES[fmt])), F.col("media_type"))
    good = contents.where((F.col("format") == fmt) & (priority > 0) & F.col("language").isin(list(LANGUAGES)))
    return good.where(usable(F.col("body")) & ~challenged(F.col("body"))) if "body" in good.columns else good, priority


def _shown(contents: DataFrame) -> list[str]:
    return ["body"] if "body" in contents.columns else ["window", "content_chars_total"]


#: What tells bodies apart but for their text.
PLACE = ("celex", "language", "format", "media_type", "part_seq")


def windows(contents: DataFrame, offset: int = 0, limit: int = WINDOW) -> DataFrame:
    """The usable bodies as a window of each shows them: window and content_chars_total in place of body, so that no more of a text is
    shuffled. celex may come later, by part_seq.

    Of bodies that differ by nothing but their text, the least text serves. Whether there are such is looked up in a job of its own,
    which reads no bodies; only then are texts shuffled, once."""
    known = [c for c in PLACE if c in contents.columns]
    good = contents.where(usable(F.col("body")) & ~challenged(F.col("body")))
    if not contents.groupBy(*known).count().where(F.col("count") > 1).isEmpty():
        good = good.withColumn("_n", F.row_number().over(Window.partitionBy(*known).orderBy("body"))).where(F.col("_n") == 1).drop("_n")
    return _window(good, "body", offset, limit).drop("body")


def representations(contents: DataFrame, fmt: str = "html") -> DataFrame:
    """The first usable body of each CELEX and language, by the order of media types. Challenges are no bodies."""
    good, priority = _usable(contents, fmt)
    shown = _shown(contents)
    best = Window.partitionBy("celex", "language").orderBy(priority, "part_seq", *shown)
    return good.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == 1).select("celex", "language", "media_type", *shown)


def in_language(contents: DataFrame, wanted: DataFrame, fmt: str = "html") -> DataFrame:
    """wanted: celex, requested, and what else goes along. The body in the requested language, else in English; available, the language served,
    and whether it fell back. contents may be windows(): then window and content_chars_total come in place of content.

    The language is chosen by what there is, without the bodies; these then come to the requests in one join, the last."""
    there = _usable(contents, fmt)[0].select("celex", "language").distinct()
    asked = wanted.select("celex", "requested", F.explode(F.array_distinct(F.array("requested", F.lit("EN")))).alias("language")).distinct()
    chosen = asked.join(there, ["celex", "language"]).groupBy("celex", "requested").agg(F.min_by("language", F.col("language") != F.col("requested")).alias("language"))
    served = wanted.join(chosen, ["celex", "requested"], "left").join(representations(contents, fmt).drop("media_type"), ["celex", "language"], "left")
    shown = [F.coalesce("body", F.lit("")).alias("content")] if "body" in served.columns else [F.coalesce("window", F.lit("")).alias("window"), F.coalesce("content_chars_total", F.lit(0)).alias("content_chars_total")]
    return served.select(
        *wanted.columns,
        F.col("language").isNotNull().alias("available"),
        F.coalesce("language", "requested").alias("language"),
        F.coalesce(F.col("language") != F.col("requested"), F.lit(False)).alias("fallback"),
        *shown,
    )


def part_urls(index: Column) -> Column:
    """The part addresses in a multipart index: hrefs to resources, each once, by their DOC number, unnumbered last, else as they stand."""
    hrefs = F.transform(F.regexp_extract_all(index, F.lit(r"""href=["']([^"']+)["']"""), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))
    urls = F.array_distinct(F.filter(hrefs, lambda u: F.contains(u, F.lit("/resource/"))))
    number = lambda u: F.when(u.rlike(r"(?i)/DOC[_-]?\d{1,17}"), F.regexp_extract(u, r"(?i)/DOC[_-]?(\d{1,17})", 1).cast("long")).otherwise(F.lit(2**62))
    keyed = F.transform(urls, lambda u, i: F.struct(number(u).alias("n"), i.alias("i"), u.alias("u")))
    return F.transform(F.array_sort(keyed), lambda x: x["u"])


def assemble(parts: DataFrame, root: str = "documents") -> DataFrame:
    """parts: doc, seq, body (null: not available). One document of the parts in order, without their prologs, under one root; null unless every part is there."""
    clean = text.strip(F.regexp_replace("body", r"^\s*<\?xml[^>]*\?>\s*|<!DOCTYPE[^>]*>\s*", ""))
    whole = parts.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seq", clean.alias("body")))).alias("p"), F.bool_and(F.col("body").isNotNull()).alias("complete"), F.count("*").alias("n_parts"))
    joined = F.array_join(F.transform("p", lambda x: x["body"]), "\n")
    return whole.select("doc", "n_parts", F.when(F.col("complete"), F.concat(F.lit(f"<{root}>\n"), joined, F.lit(f"\n</{root}>"))).alias("body"))


def window(df: DataFrame, body: str = "content", offset: int = 0, limit: int = WINDOW) -> DataFrame:
    """Adds the characters from offset to offset + limit of the body, with the offset in effect, how many, of how many, and whether more follow. Offsets count code points."""
    return placed(_window(df, body, offset, limit), offset)


def _window(df: DataFrame, body: str, offset: int, limit: int) -> DataFrame:
    return df.withColumns({"window": F.substring(F.col(body), offset + 1, limit), "content_chars_total": F.length(body)})


def placed(df: DataFrame, offset: int = 0) -> DataFrame:
    """df: window, content_chars_total. Adds the rest of what window() tells."""
    start, n = F.least(F.lit(offset), F.col("content_chars_total")), F.length("window")
    return df.withColumns({"content_offset": start, "content_chars_returned": n, "has_more": start + n < F.col("content_chars_total")})


def is_challenged(corpus: Corpus, celex: str) -> bool:
    return not corpus["contents"].where((F.col("celex") == celex) & challenged(F.col("body"))).isEmpty()


def fetch(corpus: Corpus, celex: str, language: str = "EN", fmt: str = "html") -> dict[str, object]:
    """The eager form for one document. A stored challenge is an error, an absent body is not."""
    wanted = corpus.spark.createDataFrame([(celex, language)], "celex string, requested string")
    if is_challenged(corpus, celex):
        raise RequestError("challenge", f"The body of {celex} can't be used.")
    return in_language(corpus["contents"].where(F.col("celex") == celex), wanted, fmt).first().asDict()
