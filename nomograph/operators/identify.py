"""Identifier resolution, for one identifier or a table of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from nomograph.functions import text
from nomograph.plans.config import entry_point
from nomograph.plans.errors import RequestError
from nomograph.plans.requests import given
from nomograph.sources.corpus import Corpus


def resolve(corpus: Corpus, identifiers: DataFrame) -> DataFrame:
    """identifiers: identifier, kind. found, work_uri, celex_number, resource_type (an IRI, the least of several) and date of each; the rows of misses are null."""
    types = corpus["work_types"].groupBy("work_uri").agg(F.min("type_uri").alias("type_uri"))
    best = answers(corpus, identifiers).join(types, "work_uri", "left")
    return identifiers.join(best, ["identifier", "kind"], "left").select(
        "identifier", F.col("work_uri").isNotNull().alias("found"), "work_uri", F.col("celex").alias("celex_number"), F.col("type_uri").alias("resource_type"), F.col("doc_date").alias("date")
    )


def answers(corpus: Corpus, identifiers: DataFrame) -> DataFrame:
    """identifiers: identifier, kind (celex, eli or work_uri). identifier, kind, work_uri, celex and doc_date of those that a work answers to."""
    return answered(corpus, identifiers.select("identifier", "kind")).where(F.col("work_uri").isNotNull())


def answered(corpus: Corpus, requests: DataFrame) -> DataFrame:
    """requests: identifier, kind (celex, eli or work_uri), and what else goes along. Each distinct row with the work_uri, celex and doc_date that answer to it, null if nothing does.

    A bare ELI that misses is tried once more as that of its official publication. Of several works the one with the
    least URI answers. Requests and names are shuffled once, by what both tries of an ELI have in common."""
    given_, value = requests.columns, F.trim("identifier")
    works = corpus["works"].where(F.col("celex").isNotNull()).select("work_uri", "celex", "doc_date", "eli")
    # many works have one CELEX: the least of them is found before names are shuffled
    by_celex = works.groupBy("celex").agg(F.min(F.struct("work_uri", "doc_date")).alias("w")).select(F.lit("celex").alias("kind"), F.col("celex").alias("value"), "w.work_uri", "celex", "w.doc_date")
    # an address that is the name itself isn't told twice
    kinds = (("eli", F.col("eli"), F.col("work_uri")), ("work_uri", F.col("work_uri"), F.lit(None)))
    others = works.select("celex", "doc_date", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value"), u.cast("string").alias("work_uri")) for k, v, u in kinds])).alias("n"))
    names = by_celex.unionByName(others.select("n.kind", "n.value", "n.work_uri", "celex", "doc_date").where(F.col("value").isNotNull()))
    of = _stem(F.col("kind"), F.col("value"))
    names = names.select(F.col("kind").alias("_kind"), of.alias("_of"), F.substr("value", F.length(of) + 1).alias("_end"), *[F.col(c).alias("_" + c) for c in ("work_uri", "celex", "doc_date")])
    name = F.concat("_of", "_end")
    tries = F.when(F.col("kind") == "eli", text.eli_candidates(value)).otherwise(F.array(value))
    place = F.array_position(tries, name)
    same = (F.col("kind") == F.col("_kind")) & (F.col("_stem") == F.col("_of")) & (place > 0)
    found = requests.withColumn("_stem", _stem(F.col("kind"), value)).join(names, same, "left")
    work = F.struct(place.alias("place"), F.coalesce("_work_uri", name).alias("work_uri"), F.col("_celex").alias("celex"), F.col("_doc_date").alias("doc_date"))
    best = F.min(F.when(F.col("_kind").isNotNull(), work)).alias("w")
    return found.groupBy("_stem", *given_).agg(best).select(*given_, "w.work_uri", "w.celex", "w.doc_date")


def _stem(kind: Column, value: Column) -> Column:
    """An ELI up to its act's number, which it shares with that of its official publication; any other name as it is."""
    return F.when((kind == "eli") & value.rlike(text.ELI_ACT), F.regexp_extract(value, text.ELI_ACT, 0)).otherwise(value)


@entry_point("lookup")
def lookup(corpus: Corpus, identifier: str, identifier_type: str = "auto") -> Row:
    """The eager lookup. found is false for a miss; an identifier of no recognisable kind is ambiguous."""
    value = given(identifier)
    one = corpus.spark.createDataFrame([(value,)], "identifier string")
    kind = one.select(text.identifier_kind(F.col("identifier"))).first()[0] if identifier_type == "auto" else identifier_type
    if value is None or kind is None:
        raise RequestError("ambiguous_identifier", f"{identifier!r} fits no kind of identifier.")
    return resolve(corpus, one.withColumn("kind", F.lit(kind))).first()
