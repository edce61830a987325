"""Searches for documents and cases: one row for each CELEX number, newest first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomograph.functions import dims, text
from nomograph.plans.config import entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.paging import Page, fetch, page
from nomograph.plans.requests import CaseRequest, SearchRequest
from nomograph.sources.corpus import Corpus


def english(corpus: Corpus) -> DataFrame:
    """work_uri and title of English expressions, from the index of titles where the corpus has one."""
    if corpus.titles is not None:
        return corpus.titles.texts.select(F.col("key").alias("work_uri"), F.col("text").alias("title"))
    return corpus["expressions"].where(F.col("language_uri") == dims.ENGLISH).select("work_uri", "title")


def keyword_works(corpus: Corpus, keyword: str) -> DataFrame:
    """Works whose English title has the phrase, or whose CELEX has the text. Work ids only, so that duplicates cost nothing downstream."""
    by_celex = corpus["works"].where(text.has_part(F.col("celex"), F.lit(keyword))).select("work_uri")
    if corpus.titles is not None:
        return corpus.titles.keys(keyword).select(F.col("key").alias("work_uri")).union(by_celex)
    by_title = english(corpus).where((text.phrase(F.lit(keyword)) != "") & text.has_phrase(F.col("title"), F.lit(keyword))).select("work_uri")
    return by_title.union(by_celex)


def author_works(corpus: Corpus, author: str) -> DataFrame:
    """Works of agents whose English label has the phrase; none if it has no letter or digit."""
    agents = corpus["agent_labels"].where((F.col("lang") == "en") & (text.phrase(F.lit(author)) != "") & text.has_phrase(F.col("label"), F.lit(author)))
    return corpus["work_agents"].join(agents.select("agent_uri").distinct(), "agent_uri", "left_semi").select("work_uri")


def subject_works(corpus: Corpus, concept: str) -> DataFrame:
    return corpus["work_subjects"].where(F.col("concept_uri") == concept).select("work_uri")


def in_dates(date: Column, first: str | None, last: str | None) -> list[Column]:
    """Both bounds are inclusive; a row without a date fails either."""
    return [c for c in ((date >= F.lit(first).cast("date")) if first else None, (date <= F.lit(last).cast("date")) if last else None) if c is not None]


def collapse(works: DataFrame, types: DataFrame, titles: DataFrame, offset: int, limit: int) -> DataFrame:
    """A page of CELEX numbers with their types, date, title and work.

    The page is found by one aggregation of the works that pass, which also collects each number's works (a handful), so
    that filters are planned once: both uses of the page read one shuffle. Its works, limit numbers' at most, are broadcast
    to titles and types, and one aggregation gives the rows. A CELEX may stand for several works: the work with a title is
    preferred, and titles and works are each the greatest of theirs."""
    by_number = works.groupBy("celex").agg(F.min("doc_date").alias("date"), F.collect_set("work_uri").alias("works"))
    ours = page(by_number, [F.col("date").desc_nulls_last(), F.col("celex")], offset, limit).select("celex", "date", F.explode("works").alias("work_uri"))
    none = F.lit(None).cast("string")
    facts = titles.where(F.col("title").isNotNull()).select("work_uri", "title", none.alias("type_uri")).unionByName(types.select("work_uri", none.alias("title"), "type_uri"))
    known = facts.join(F.broadcast(ours), "work_uri").select("celex", "date", "work_uri", "title", "type_uri")
    every = ours.select("celex", "date", "work_uri", none.alias("title"), none.alias("type_uri")).unionByName(known)
    rows = every.groupBy("celex", "date").agg(
        F.min("work_uri").alias("any_work"), F.max(F.when(F.col("title").isNotNull(), F.col("work_uri"))).alias("titled_work"), F.max("title").alias("title"), F.collect_set("type_uri").alias("types")
    )
    return rows.select(
        F.coalesce("titled_work", "any_work", F.lit("")).alias("work_uri"),
        F.col("celex").alias("celex_number"),
        text.is_consolidated(F.col("celex")).alias("is_consolidated"),
        dims.type_labels(F.col("types")).alias("resource_type"),
        "date",
        "title",
    )


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("date").desc_nulls_last(), "celex_number")


def hits(corpus: Corpus, request: SearchRequest) -> tuple[DataFrame, DataFrame]:
    """All works that pass every given filter, and the types that count: a type filter also limits the types that are listed."""
    works = corpus["works"].where(F.col("celex").isNotNull())
    for condition in in_dates(F.col("doc_date"), request.date_from, request.date_to):
        works = works.where(condition)
    if request.in_force:
        works = works.where(F.col("in_force"))
    types = corpus["work_types"]
    if request.document_type:
        wanted = [dims.TYPE + dims.DOCUMENT_TYPES[request.document_type]] + [dims.TYPE + dims.CONSOLIDATED_TYPE] * request.include_consolidated
        types = types.where(F.col("type_uri").isin(wanted))
        works = works.join(types, "work_uri", "left_semi")
    if request.concept:
        works = works.join(subject_works(corpus, request.concept), "work_uri", "left_semi")
    if request.author:
        works = works.join(author_works(corpus, request.author), "work_uri", "left_semi")
    if request.keyword:
        works = works.join(keyword_works(corpus, request.keyword), "work_uri", "left_semi")
    return works, types


def search_documents(corpus: Corpus, request: SearchRequest) -> DataFrame:
    """A page of the documents that pass every given filter."""
    works, types = hits(corpus, request)
    return collapse(works, types, english(corpus), request.offset, min(request.limit, corpus.settings.row_ceiling))


def search_cases(corpus: Corpus, request: CaseRequest) -> DataFrame:
    """Cases that pass every given filter, with the title's parts. Derivative records are left out unless a case type or include_derivative says otherwise."""
    works = corpus["works"].where(F.startswith(F.col("celex"), F.lit("6")))
    if request.case_number:
        number = F.lit(request.case_number)
        fragment = text.case_fragment(number)
        works = works.where(F.when(fragment.isNotNull(), F.contains(F.col("celex"), fragment)).otherwise(text.has_part(F.col("celex"), number)))
    if request.court:
        works = works.where(reduce(Column.__or__, [F.contains(F.col("celex"), F.lit(code)) for code in dims.COURTS[request.court]]))
    for condition in in_dates(F.col("doc_date"), request.date_from, request.date_to):
        works = works.where(condition)
    types = corpus["work_types"]
    if request.case_type:
        works = works.join(types.where(F.col("type_uri") == dims.TYPE + dims.CASE_TYPES[request.case_type]), "work_uri", "left_semi")
    elif not request.include_derivative:
        works = works.join(types.where(F.col("type_uri").isin([dims.TYPE + t for t in dims.DERIVATIVE_TYPES])), "work_uri", "left_anti")
    if request.keyword:
        works = works.join(keyword_works(corpus, request.keyword), "work_uri", "left_semi")
    found = collapse(works, types, english(corpus), request.offset, min(request.limit, corpus.settings.row_ceiling)).drop("is_consolidated")
    parts = text.case_title(F.col("title"))
    return found.withColumn("_t", parts).select("*", "_t.display_title", "_t.parties", "_t.subject_matter", "_t.case_reference").drop("_t")


def _eager(corpus: Corpus, found: DataFrame, request: SearchRequest | CaseRequest) -> Page:
    result = fetch(newest_first(found), request.offset, request.limit, corpus.settings.row_ceiling, request.echo())
    if not result.rows:
        raise RequestError("no_results", f"Nothing matches {request.echo()}.")
    return result


@entry_point("find_documents")
def find_documents(corpus: Corpus, **filters: object) -> Page:
    """The eager search: a page of rows; raises no_filters or no_results."""
    request = SearchRequest(**filters)
    return _eager(corpus, search_documents(corpus, request), request)


@entry_point("find_cases")
def find_cases(corpus: Corpus, **filters: object) -> Page:
    request = CaseRequest(**filters)
    return _eager(corpus, search_cases(corpus, request), request)
