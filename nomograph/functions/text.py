"""Scalar functions on identifiers, titles and text, as Column expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammars of identifiers.
ACT_CORE = r"^[0-9A-Z](\d{4}[A-Z]{1,2}\d+)"
CONSOLIDATED = r"^0(\d{4}[A-Z]{1,2}\d+)-(\d{4})(\d{2})(\d{2})$"
CASE_NUMBER = r"^([CT])-(\d+)/(\d{2,4})$"
CELEX = r"^[1-9]\d{4}[A-Z]+\d+"
ELI_ACT = r"^http://data\.europa\.eu/eli/[^/]+/\d{4}/[^/]+"


def _group(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


# White space as readers of the web trim it: the ASCII kinds, no-break spaces, every space separator, line separators.
BLANK = "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def strip(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(BLANK))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def phrase(text: Column) -> Column:
    """Letters and digits of any script as they are, everything else as single spaces between them."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}\s]+", " "), r"\s+", " "))


def has_phrase(text: Column, wanted: Column) -> Column:
    """Whether the words of wanted stand next to each other in text, whatever the case."""
    pad = lambda c: F.concat(F.lit(" "), F.lower(phrase(c)), F.lit(" "))
    return F.contains(pad(text), pad(wanted))


def has_part(text: Column, part: Column) -> Column:
    """Case-insensitive substring."""
    return F.contains(F.lower(text), F.lower(part))


def act_core(celex: Column) -> Column:
    """Year, type and number of the act, without the sector: equal for an act and its consolidations."""
    return _group(celex, ACT_CORE)


def is_consolidated(celex: Column) -> Column:
    return F.coalesce(celex.rlike(CONSOLIDATED), F.lit(False))


def consolidation_date(celex: Column) -> Column:
    """The suffix's date as text, yyyy-mm-dd, even if no such day exists."""
    return F.when(celex.rlike(CONSOLIDATED), F.regexp_replace(celex, CONSOLIDATED, "$2-$3-$4"))


def case_fragment(number: Column) -> Column:
    """C-131/12 -> 2012CJ0131; null for any other notation. Two-digit years up to 60 are of this century; more digits stand as they are."""
    n = F.upper(F.trim(number))
    digits, year = F.regexp_extract(n, CASE_NUMBER, 2), F.regexp_extract(n, CASE_NUMBER, 3)
    century = F.when(F.length(year) != 2, "").when(year <= "60", "20").otherwise("19")
    court = F.concat(F.regexp_extract(n, CASE_NUMBER, 1), F.lit("J"))
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return F.when(n.rlike(CASE_NUMBER), F.concat(century, year, court, padded))


def identifier_kind(identifier: Column) -> Column:
    """celex, eli, or null if neither fits."""
    t = F.trim(identifier)
    return F.when(t.rlike(CELEX), "celex").when(F.startswith(t, F.lit("http://data.europa.eu/eli/")), "eli")


def bare_eli(eli: Column) -> Column:
    """Whether a work-level ELI names no manifestation: type, year and number only."""
    path = F.regexp_replace(F.regexp_replace(eli, "^http://data.europa.eu/eli/", ""), "/+$", "")
    return F.startswith(eli, F.lit("http://data.europa.eu/eli/")) & path.rlike(r"^[^/]+/\d{4}/[^/]+$")


def eli_candidates(eli: Column) -> Column:
    """The ELI itself, then, for a bare one, that of its official publication."""
    official = F.concat(F.regexp_replace(eli, "/+$", ""), F.lit("/oj"))
    return F.when(bare_eli(eli), F.array(eli, official)).otherwise(F.array(eli))


def safe_iri(value: Column) -> Column:
    return F.startswith(value, F.lit("http")) & ~value.rlike(r'[\s<>"]')


def lexical_boolean(value: Column) -> Column:
    return F.when(value.isin("true", "1"), True).when(value.isin("false", "0"), False)


def case_title(title: Column) -> Column:
    """A case title's parts as a struct (case_reference, display_title, parties, subject_matter), each null if absent.

    Parts are separated by #: the second names the parties; the last that isn't empty is the reference if it reads
    "Case ..." and comes after the parties; the one before it (or it) is the subject."""

    def fields(s: Column, last: Column) -> Column:
        at = lambda i: F.nullif(F.get(s, (i - 1).cast("int")), F.lit(""))  # noqa: E731  null beyond the parts
        end = F.when(last >= 3, at(last))
        is_case = F.coalesce(end.rlike(r"(?i)^Cases?\b"), F.lit(False))
        subject = F.when(is_case, last - 1).otherwise(last)
        parties = at(F.lit(2))
        return F.struct(
            F.when(is_case, end).alias("case_reference"),
            F.coalesce(parties, at(F.lit(1))).alias("display_title"),
            parties.alias("parties"),
            F.when(subject >= 3, at(subject)).alias("subject_matter"),
        )

    def last_of(s: Column) -> Column:
        return F.array_max(F.transform(s, lambda x, i: F.when(x != "", i + 1).otherwise(0)))

    parts = F.transform(F.split(title, "#", -1), strip)
    return F.when(F.contains(title, F.lit("#")), _let(parts, lambda s: _let(last_of(s), lambda last: fields(s, last))))


ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman(numeral: Column) -> Column:
    """The value of a Roman numeral, read from the right: what is less than the greatest so far counts against it. Null for other text."""
    value = F.create_map(*[F.lit(x) for pair in ROMAN.items() for x in pair])
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("top"))

    def add(acc: Column, c: Column) -> Column:
        v = F.coalesce(F.try_element_at(value, c), F.lit(0))
        return F.struct(F.when(v < acc["top"], acc["total"] - v).otherwise(acc["total"] + v).alias("total"), F.greatest(acc["top"], v).alias("top"))

    return F.when(numeral.rlike("^[IVXLCDM]+$"), F.aggregate(F.reverse(F.split(numeral, "")), zero, add)["total"])


def number_value(token: Column) -> Column:
    return F.coalesce(roman(token), F.when(token.rlike(r"^\d{1,9}$"), token.cast("int")))


def same_number(a: Column, b: Column) -> Column:
    return (a == b) | F.coalesce(number_value(a) == number_value(b), F.lit(False))


#: Named character references of bodies, in the order in which they are read.
NAMED = (("(?i)&nbsp;", " "), ("(?i)&amp;", "&"), ("(?i)&lt;", "<"), ("(?i)&gt;", ">"))


def decoded(text: Column) -> Column:
    """Character references of HTML that bodies use, in this order, so that &amp;lt; becomes <. Decimal ones are read with the rest of the text between them."""
    named = text
    for pattern, char in NAMED:
        named = F.regexp_replace(named, pattern, char)
    codes = F.regexp_extract_all(named, F.lit(r"&#(\d{1,7});"), F.lit(1))
    pieces = F.split(named, r"&#\d{1,7};", -1)
    char = lambda c: F.decode(F.unhex(F.lpad(F.hex(c.cast("int")), 8, "0")), "UTF-32")
    both = F.zip_with(pieces, codes, lambda p, c: F.concat(p, F.when(c.isNull(), "").otherwise(char(c))))
    return F.when(F.size(codes) == 0, named).otherwise(F.array_join(both, ""))


def visible(line: Column) -> Column:
    """A line's text as a reader sees it: no tags, character references decoded, white space collapsed."""
    return F.trim(F.regexp_replace(decoded(F.regexp_replace(line, "<[^>]*>", " ")), r"(?U)\s+", " "))


def term(kind: Column, value: Column, datatype: Column, lang: Column) -> Column:
    """A term in Turtle's notation."""
    short = F.when(F.startswith(datatype, F.lit("http://www.w3.org/2001/XMLSchema#")), F.concat(F.lit("xsd:"), F.substring_index(datatype, "#", -1))).otherwise(F.concat(F.lit("<"), datatype, F.lit(">")))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return (
        F.when(kind == "uri", F.concat(F.lit("<"), value, F.lit(">")))
        .when(kind == "bnode", F.concat(F.lit("_:"), value))
        .when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang))
        .when(datatype.isNotNull(), F.concat(quoted, F.lit("^^"), short))
        .otherwise(quoted)
    )
