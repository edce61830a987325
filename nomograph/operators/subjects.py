"""Search in the multilingual thesaurus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.functions import dims, text
from nomograph.plans.config import entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.paging import Page, fetch, page
from nomograph.plans.requests import SubjectRequest
from nomograph.sources.corpus import Corpus


def search_subjects(corpus: Corpus, request: SubjectRequest) -> DataFrame:
    """Concepts whose label in the language has the keyword: URI, label, code and the label of a broader concept, by label and URI."""
    labels = corpus["concept_labels"].where(F.col("lang") == request.language).select("concept_uri", "label")
    hits = labels.where(F.startswith("concept_uri", F.lit(dims.CONCEPT)) & text.has_part(F.col("label"), F.lit(request.keyword)))
    hits = hits.join(corpus["concepts"], "concept_uri", "left_semi").distinct()
    # the page is found on labels alone; notations and broader labels are joined to its rows
    hits = page(hits, ["label", "concept_uri"], request.offset, min(request.limit, corpus.settings.row_ceiling))
    codes = corpus["concept_notations"].join(F.broadcast(hits.select("concept_uri")), "concept_uri", "left_semi").groupBy("concept_uri").agg(F.min("notation").alias("concept_code"))
    broader = corpus["concept_broader"].join(F.broadcast(hits.select("concept_uri")), "concept_uri", "left_semi")
    broader = broader.join(labels.select(F.col("concept_uri").alias("broader_uri"), F.col("label").alias("broader")), "broader_uri").groupBy("concept_uri").agg(F.min("broader").alias("broader_label"))
    return hits.join(codes, "concept_uri", "left").join(broader, "concept_uri", "left").select("concept_uri", F.col("label").alias("pref_label"), "concept_code", "broader_label")


@entry_point("find_subjects")
def find_subjects(corpus: Corpus, **arguments: object) -> Page:
    request = SubjectRequest(**({"language": corpus.settings.language} | arguments))
    result = fetch(search_subjects(corpus, request).orderBy("pref_label", "concept_uri"), request.offset, request.limit, corpus.settings.row_ceiling, request.echo())
    if not result.rows:
        raise RequestError("no_concepts", f"No concept matches {request.keyword!r}.")
    return result
