"""A document's metadata, and the fetch that puts metadata, staleness and body together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.functions import dims
from nomograph.operators import content, identify, markdown, relations, structure
from nomograph.plans.config import entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.requests import WINDOW, DocumentRequest, exactly_one
from nomograph.session import cut
from nomograph.sources.corpus import Corpus

BASIS = dims.RELATIONS["legal_basis"][0]


#: The fields of metadata, beside celex_number and work_uri, and the facts that each is made of.
FIELDS = {
    "resource_type": "type",
    "date": None,
    "title": "title",
    "in_force": None,
    "author_institution": "author",
    "author_institutions": "author",
    "legal_basis": "basis",
    "eurovoc_subjects": "subject",
}
SETS = {"author_institutions": "author", "legal_basis": "basis", "eurovoc_subjects": "subject"}


def _facts(corpus: Corpus, tags: tuple[str, ...] = ("title", "type", "author", "basis", "subject")) -> DataFrame:
    """What is told of works under these tags, one value a row, some of them several times: work_uri, tag, value."""
    tables = {
        "title": (corpus["expressions"].where(F.col("language_uri") == dims.ENGLISH), "work_uri", "title"),
        "type": (corpus["work_types"], "work_uri", "type_uri"),
        "author": (corpus.repeated("work_agents"), "work_uri", "agent_uri"),
        "basis": (corpus.repeated("edges").where(F.col("predicate") == BASIS), "src_uri", "dst_uri"),
        "subject": (corpus.repeated("work_subjects"), "work_uri", "concept_uri"),
    }
    rows = [t.select(F.col(key).alias("work_uri"), F.lit(tag).alias("tag"), F.col(value).alias("value")) for tag, (t, key, value) in tables.items() if tag in tags]
    return reduce(DataFrame.unionByName, rows)


def metadata(corpus: Corpus, celexes: DataFrame, fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """celexes: celex. Core fields and the whole sets of authors, legal bases and subjects of each, or those of these that are
    asked for. All facts are joined once, to the works, and aggregated by work and then by CELEX, so that none multiplies or crowds
    out another. Facts of fields that aren't asked for aren't read."""
    asked, of = celexes.distinct(), lambda tag: F.when(F.col("tag") == tag, F.col("value"))
    sets = {n: t for n, t in SETS.items() if n in fields}
    tags = {"title", *(FIELDS[n] for n in fields)} - {None}
    core = {"type_uri": "resource_type", "doc_date": "date", "title": "title", "in_force": "in_force"}
    core = [c for c, n in core.items() if n in fields]
    works = corpus["works"].select("work_uri", "celex", *[c for c in core if c in ("doc_date", "in_force")]).where(F.col("celex").isNotNull())
    facts = _facts(corpus, tuple(tags))
    values = [F.max(of("title")).alias("title")]
    if "type" in tags:
        values.append(F.min(of("type")).alias("type_uri"))
    if "author_institution" in fields:
        values.append(F.min(of("author")).alias("first"))
    values += [F.collect_set(of(t)).alias(t) for t in sets.values()]
    if sets:
        works = works.join(asked, "celex", "left_semi")
        each = works.join(facts, "work_uri", "left").groupBy(*works.columns).agg(*values)
    else:  # a work's facts come to a row, most of them before they are shuffled
        each = works.join(facts.groupBy("work_uri").agg(*values), "work_uri", "left")
    # one work answers: of those with a title, the one of the least URI
    whole = [F.min(F.struct(F.col("title").isNull().alias("untitled"), "work_uri", *core)).alias("c")]
    if "author_institution" in fields:
        whole.append(F.min("first").alias("first"))
    whole += [F.array_sort(F.array_distinct(F.flatten(F.collect_list(t)))).alias(t) for t in sets.values()]
    found = each.groupBy("celex").agg(*whole)
    if not sets:
        found = found.join(asked, "celex", "left_semi")
    some = lambda t: F.when(F.size(t) > 0, F.col(t))
    made = {
        "resource_type": lambda: dims.type_label(F.col("c.type_uri")),
        "date": lambda: F.col("c.doc_date"),
        "title": lambda: F.col("c.title"),
        "in_force": lambda: F.col("c.in_force"),
        "author_institution": lambda: dims.body_label(F.col("first")),
        "author_institutions": lambda: F.array_distinct(F.transform(some("author"), dims.body_label)),
        "legal_basis": lambda: some("basis"),
        "eurovoc_subjects": lambda: some("subject"),
    }
    return found.select(F.col("celex").alias("celex_number"), "c.work_uri", *[make().alias(n) for n, make in made.items() if n in fields])


def staleness(corpus: Corpus, celexes: DataFrame) -> DataFrame:
    """Whether a newer consolidated version of each act exists, which, and its date."""
    works = corpus["works"].groupBy("celex").agg(F.min("work_uri").alias("source_uri"))
    sources = works.join(celexes.distinct(), "celex", "left_semi").withColumnRenamed("celex", "source_celex")
    newest = relations.latest_consolidated(corpus, sources.select("source_uri", "source_celex"))
    return newest.select(F.col("source_celex").alias("celex"), F.lit(True).alias("is_superseded"), F.col("current_celex").alias("current_consolidated_celex"), F.col("as_of").alias("consolidated_as_of"))


def documents(corpus: Corpus, requests: DataFrame, fmt: str = "html", content_mode: str = "paged", offset: int = 0, limit: int = WINDOW, fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """requests: identifier, kind (celex, eli or work_uri), language, resolve (as_requested or current_consolidated). A row for each
    request: requested_celex, null if nothing answers; the metadata of the document served (or the fields asked for); whether a newer
    consolidated version exists; and its body in the language or else in English, whole or a window of it. Where a window is asked
    for, contents may be content.windows() of the same offset and limit.

    Requests are resolved in a job of its own, and what they come to (a row each, without bodies) is written to the shared
    folder. All that is told of a document is found once for each CELEX, language and way to resolve it; requests meet it last."""
    asked = identify.answered(corpus, requests.select("identifier", "kind", "language", "resolve"))
    asked = cut(asked.select("identifier", "kind", F.col("language").alias("requested_language"), "resolve", F.col("celex").alias("requested_celex")))
    told = asked.where(F.col("requested_celex").isNotNull()).select("requested_celex", "requested_language", "resolve").distinct()
    stale = staleness(corpus, told.select(F.col("requested_celex").alias("celex")))
    told = told.join(stale.withColumnRenamed("celex", "requested_celex"), "requested_celex", "left")
    served = F.when(F.col("resolve") == "current_consolidated", F.coalesce("current_consolidated_celex", "requested_celex")).otherwise(F.col("requested_celex"))
    told = cut(told.withColumn("celex_number", served))
    rows = told.join(metadata(corpus, told.select(F.col("celex_number").alias("celex")), fields), "celex_number", "left")
    if content_mode == "metadata_only":
        return _of_requests(asked, rows)
    contents = corpus["contents"]
    if content_mode != "full" and fmt != "markdown" and "body" in contents.columns:
        contents = content.windows(contents, offset, limit)
    bodies = content.in_language(contents, rows.withColumnsRenamed({"celex_number": "celex", "requested_language": "requested"}), fmt)
    if fmt == "markdown":
        bodies = markdown.render(bodies, "content", "content")
    if content_mode == "full":
        total = F.length("content")
        bodies = bodies.withColumns({"content_offset": F.lit(0), "content_chars_returned": total, "content_chars_total": total, "has_more": F.lit(False)})
    else:
        bodies = content.placed(bodies, offset) if "window" in bodies.columns else content.window(bodies, offset=offset, limit=limit)
        bodies = bodies.withColumn("content", F.col("window")).drop("window")
    bodies = bodies.withColumnsRenamed({"celex": "celex_number", "requested": "requested_language", "available": "content_available", "fallback": "language_fallback"})
    return _of_requests(asked, bodies)


def _of_requests(asked: DataFrame, told: DataFrame) -> DataFrame:
    """Each request with what is told of its CELEX, in its language and its way to resolve it; both of these may be null."""
    key = ("requested_celex", "requested_language", "resolve")
    told = told.withColumnsRenamed({k: f"_{k}" for k in key})
    same = (F.col(key[0]) == F.col(f"_{key[0]}")) & F.col(key[1]).eqNullSafe(F.col(f"_{key[1]}")) & F.col(key[2]).eqNullSafe(F.col(f"_{key[2]}"))
    return asked.join(told, same, "left").drop(*[f"_{k}" for k in key]).withColumn("is_superseded", F.coalesce("is_superseded", F.lit(False)))


@entry_point("fetch_document")
def fetch_document(corpus: Corpus, **arguments: object) -> dict[str, object]:
    """The eager fetch of one document: absent fields are left out, and an unavailable body is a flag. A stored challenge is an error."""
    request = DocumentRequest(**arguments)
    kind, identifier = exactly_one(celex=request.celex, eli=request.eli, work_uri=request.work_uri)
    one = corpus.spark.createDataFrame([(identifier, kind, request.language, request.resolve)], "identifier string, kind string, language string, resolve string")
    whole = "metadata_only" if request.content_mode == "metadata_only" else "full"
    row = documents(corpus, one, request.format, whole).first().asDict()
    if row["requested_celex"] is None:
        raise RequestError("not_found", "No document answers to the identifier.")
    if row["work_uri"] is None:
        raise RequestError("not_found", f"No document has the CELEX {row['celex_number']}.")
    hidden = {"identifier", "kind", "resolve", "requested_language", "requested_celex", "language_fallback", "language", "content", "content_offset", "content_chars_returned", "content_chars_total", "has_more"}
    result = {k: v for k, v in row.items() if v is not None and k not in hidden and (k != "is_superseded" or v)}
    if row["celex_number"] != row["requested_celex"]:
        result["requested_celex"] = row["requested_celex"]
    result |= {"content_mode": request.content_mode, "content_format": request.format, "language": request.language, "has_more": False}
    if request.content_mode == "metadata_only":
        return result
    if not row["content_available"] and content.is_challenged(corpus, row["celex_number"]):
        raise RequestError("challenge", f"The body of {row['celex_number']} can't be used.")
    result["language"] = row["language"]
    if row["language_fallback"]:
        result["language_fallback"] = f"{request.language} is not available; {row['language']} is served."
    if row["content_available"]:
        result |= _view(request, row["content"])
    return result


def _view(request: DocumentRequest, full: str) -> dict[str, object]:
    """What is shown of a body: its outline, else selected sections, else all of it, else a window."""
    out: dict[str, object] = {"content_chars_total": len(full), "has_more": False}
    if request.outline or request.select:
        headings = structure.outline(full, request.format)
        out["structure_detected"] = bool(headings)
        if request.outline:
            return out | {"outline": headings, "content_chars_returned": 0}
        picked = structure.select_sections(full, headings, request.select)
        out |= {"selection": {k: picked[k] for k in ("requested", "matched", "missed")}, "content_chars_returned": len(picked["text"])}
        return out | ({"content": picked["text"]} if picked["text"] else {})
    start = 0 if request.content_mode == "full" else min(request.offset, len(full))
    text_ = full if request.content_mode == "full" else full[start : start + request.limit]
    out |= {"content_offset": start, "content_chars_returned": len(text_), "has_more": start + len(text_) < len(full)}
    return out | ({"content": text_} if text_ else {})


def metadata_snapshots(corpus: Corpus, celexes: DataFrame) -> DataFrame:
    """celexes: celex. The core fields and authors of each."""
    return metadata(corpus, celexes, tuple(f for f in FIELDS if f not in ("legal_basis", "eurovoc_subjects")))


def metadata_snapshot(corpus: Corpus, celex: str) -> DataFrame:
    """The same for one work; an empty table if there is none."""
    return metadata_snapshots(corpus, corpus.spark.createDataFrame([(celex,)], "celex string"))
