"""Table functions that ad-hoc statements may call for each row, by a lateral join: FROM t, LATERAL outline(t.body) h.

They are SQL functions: Spark plans a statement together with the functions that it calls, as expressions on arrays and joins; no
Python runs. Each says the same as the operator of its name over whole tables (structure.outline_lines,
content.part_urls), whose patterns it uses.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from nomograph.functions.text import NAMED
from nomograph.operators import structure


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _visible(line: str) -> str:
    """A line's text as a reader sees it, as SQL; text.visible as columns."""
    named = f"regexp_replace({line}, '<[^>]*>', ' ')"
    for pattern, char in NAMED:
        named = f"regexp_replace({named}, {_quoted(pattern)}, {_quoted(char)})"
    char = "decode(unhex(lpad(hex(CAST(c AS INT)), 8, '0')), 'UTF-32')"
    codes = f"array_join(zip_with(split(n, '&#\\\\d{{1,7}};', -1), regexp_extract_all(n, '&#(\\\\d{{1,7}});', 1), (p, c) -> concat(p, CASE WHEN c IS NULL THEN '' ELSE {char} END)), '')"
    return f"trim(regexp_replace(element_at(transform(array({named}), n -> {codes}), 1), '(?U)\\\\s+', ' '))"


_KIND = "CASE " + " ".join(f"WHEN v RLIKE {_quoted(p)} THEN '{name}'" for name, p in structure.KINDS) + " END"
_NUMBER = "CASE structural " + " ".join(f"WHEN '{name}' THEN upper(regexp_extract(v, {_quoted(p)}, 1))" for name, p in structure.KINDS) + f" ELSE regexp_extract(v, {_quoted(structure.RECITAL)}, 1) END"
_LABEL = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{label}'" for k, label in structure.LABELS.items()) + " END"

#: Lines whose lengths are added up at once.
_RUN = 64


def _let(name: str, value: str, then: str) -> str:
    """SQL of then, in which name stands for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def _outline(body: str) -> str:
    """SQL of a body's headings as an array. A body stays in its row: windows over its lines would carry it along with each of them.

    Lines without text are left out, so a heading's following line is the next one. Where a line starts is the sum of the runs of lines before its own, and of the lines before it in that."""
    total = lambda sizes: f"aggregate({sizes}, 0L, (a, n) -> a + n)"
    at = f"starts[x.j div {_RUN}] + " + total(f"slice(sizes, x.j div {_RUN} * {_RUN} + 1, x.j % {_RUN})")
    inline = f"CASE WHEN structural = 'annex' THEN nullif(trim(regexp_extract(v, {_quoted(structure.ANNEX)}, 2)), '') END"
    title = f"CASE WHEN structural IS NOT NULL THEN coalesce({inline}, CASE WHEN x.after.structural IS NULL AND length(x.after.v) <= {structure.LONGEST_TITLE} THEN x.after.v END) END"
    of = lambda sql: sql.replace("RLIKE", "\0").replace("structural", "x.structural").replace("after.x.", "after.").replace("(v,", "(x.v,").replace("WHEN v ", "WHEN x.v ").replace("\0", "RLIKE")
    heading = _let("kind", of("coalesce(structural, 'recital')"), _let("number", of(_NUMBER), f"named_struct('kind', kind, 'number', number, 'label', CASE WHEN kind = 'annex' AND number = '' THEN 'ANNEX' ELSE concat_ws(' ', {_LABEL}, number) END, 'title', {of(title)}, 'at', {at})"))
    found = f"filter(transform(marked, (x, k) -> named_struct('j', x.j, 'v', x.v, 'structural', x.structural, 'after', get(marked, k + 1))), x -> x.structural IS NOT NULL OR (x.v RLIKE {_quoted(structure.RECITAL)} AND x.j < enacting))"
    found = _let("enacting", "array_min(transform(filter(marked, x -> x.structural IN ('article', 'chapter', 'section')), x -> x.j))", f"transform({found}, x -> {heading})")
    texts = f"filter(transform(lines, (line, j) -> named_struct('j', j, 'v', {_visible('line')})), x -> x.v <> '')"
    marked = f"transform({texts}, x -> named_struct('j', x.j, 'v', x.v, 'structural', {of(_KIND)}))"
    runs = f"transform(sequence(0, (size(lines) - 1) div {_RUN}), r -> " + total(f"slice(sizes, r * {_RUN} + 1, {_RUN})") + ")"
    starts = "transform(runs, (n, r) -> " + total("slice(runs, 1, r)") + ")"
    found = _let("sizes", "transform(lines, line -> length(line) + 1L)", _let("starts", _let("runs", runs, starts), _let("marked", marked, found)))
    return _let("lines", f"split({body}, '\\n', -1)", found)


OUTLINE = f"""CREATE OR REPLACE TEMPORARY FUNCTION outline(body STRING) RETURNS TABLE (kind STRING, number STRING, label STRING, title STRING, offset BIGINT) RETURN
SELECT inline({_outline("body")})"""

PART_URLS = """CREATE OR REPLACE TEMPORARY FUNCTION part_urls(index STRING) RETURNS TABLE (position INT, url STRING) RETURN
SELECT posexplode(transform(array_sort(transform(array_distinct(filter(transform(regexp_extract_all(index, 'href=[\\\\x22\\\\x27]([^\\\\x22\\\\x27]+)[\\\\x22\\\\x27]', 1), u -> replace(u, '&amp;', '&')), u -> contains(u, '/resource/'))),
  (u, i) -> struct(CASE WHEN u RLIKE '(?i)/DOC[_-]?\\\\d{1,17}' THEN CAST(regexp_extract(u, '(?i)/DOC[_-]?(\\\\d{1,17})', 1) AS BIGINT) ELSE 4611686018427387904 END AS n, i AS i, u AS u))), x -> x.u))"""

#: name -> its statement.
FUNCTIONS = {"outline": OUTLINE, "part_urls": PART_URLS}


def register(session: SparkSession) -> None:
    """Makes the functions known to a session."""
    for statement in FUNCTIONS.values():
        session.sql(statement)
