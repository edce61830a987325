"""Relations over many hops: what works reach, and what thesaurus concepts hold with all that is narrower."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomograph.functions.dims import RELATIONS
from nomograph.session import cut, dealt
from nomograph.sources.corpus import Corpus


def closure(edges: DataFrame, seeds: DataFrame, hops: int | None = None) -> DataFrame:
    """edges: src, dst; seeds: source. source, reached, hops (the least) of all that each seed reaches in one hop or more, itself left out.

    Semi-naive: each round joins only the pairs that the last one has found, and what was known before is taken out, so a
    cycle ends by itself. Ends after so many hops, or when nothing is new. Each round is written to the shared folder."""
    edges = cut(edges.select("src", "dst").distinct())
    frontier = seeds.select("source", F.col("source").alias("reached")).distinct()
    known = cut(frontier.withColumn("hops", F.lit(0)))
    frontier, n = known.select("source", "reached"), 0
    while hops is None or n < hops:
        n += 1
        step = frontier.join(edges, F.col("reached") == F.col("src")).select("source", F.col("dst").alias("reached")).distinct()
        frontier = cut(step.join(known.select("source", "reached"), ["source", "reached"], "left_anti"))
        if frontier.isEmpty():
            break
        known = known.unionByName(frontier.withColumn("hops", F.lit(n)))
    return known.where("hops > 0")


def relations_closure(corpus: Corpus, seeds: DataFrame, types: tuple[str, ...] = ("cites",), hops: int | None = None) -> DataFrame:
    """seeds: source. What each work reaches by relations of these types in their outgoing direction."""
    edges = corpus["edges"].where(F.col("predicate").isin([RELATIONS[t][0] for t in types]))
    return closure(edges.select(F.col("src_uri").alias("src"), F.col("dst_uri").alias("dst")), seeds, hops)


def ancestors(broader: DataFrame, used: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """broader: concept_uri, broader_uri, a graph of any shape; used: concept_uri. concept_uri and ancestor of each used concept, itself among them.

    Pointer doubling: jumps of 1, 2, 4, ... steps are made each from the jumps before, and each round carries every used
    concept on by one of them, so rounds grow with the logarithm of the longest chain. Ends when a round adds nothing,
    as then no concept is further away. rounds, if given, gets the rows after each."""
    jumps = cut(broader.where("broader_uri IS NOT NULL").select(F.col("concept_uri").alias("low"), F.col("broader_uri").alias("high")).distinct())
    found = cut(used.select("concept_uri", F.col("concept_uri").alias("ancestor")).distinct())
    n = found.count()
    while True:
        further = found.join(jumps, F.col("ancestor") == F.col("low")).select("concept_uri", F.col("high").alias("ancestor"))
        found = cut(found.unionByName(further).distinct())
        before, n = n, found.count()
        if rounds is not None:
            rounds.append(n)
        if n == before:
            return found
        on = jumps.select(F.col("low").alias("high"), F.col("high").alias("higher"))
        jumps = cut(jumps.join(on, "high").select("low", F.col("higher").alias("high")).distinct())


def rolled_up(corpus: Corpus) -> DataFrame:
    """concept_uri, n_direct, n_works of every concept: works of its own, and works of it and of all that is narrower, each work once."""
    subjects = corpus.repeated("work_subjects").select("work_uri", "concept_uri")
    own = dealt(subjects, "work_uri").distinct()
    direct = own.groupBy("concept_uri").agg(F.count("*").alias("n_direct"))
    up = ancestors(corpus["concept_broader"], subjects.select("concept_uri"))
    # dealt by concept to meet all that is broader, then by work, where each concept counts once
    met = dealt(own, "concept_uri").join(dealt(up, "concept_uri"), "concept_uri").select(F.col("ancestor").alias("concept_uri"), "work_uri")
    under = dealt(met, "work_uri").distinct()
    whole = under.groupBy("concept_uri").agg(F.count("*").alias("n_works"))
    every = corpus["concepts"].select("concept_uri").distinct().join(direct, "concept_uri", "left").join(whole, "concept_uri", "left")
    return every.select("concept_uri", F.coalesce("n_direct", F.lit(0)).alias("n_direct"), F.coalesce("n_works", F.lit(0)).alias("n_works"))
