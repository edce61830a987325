"""A training corpus from raw documents: rules, near-duplicates, secrets, mixing, encoding.

Each stage reads what the one before wrote, so a lost executor costs a stage's tasks at most, and no stage's plan
grows with the pipeline. All stages but the last keep the columns of documents.

quality_rules  drops documents that a rule rejects
near_dedup     keeps the document of the least doc_id of each group of near duplicates
secret_scan    replaces secrets in the text (and counts its characters anew)
mixing         takes whole documents by source, some twice, some not at all, towards the sources' target weights
byte_bpe       returns doc_id, ids (the text's tokens) and decoded_sha256 (of the text decoded from them); a document that the mix takes twice has two rows

Defined cases are those of the operators; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm import bpe, minhash, mixing, rules, secrets
from nomograph.llm.common import folder_in, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.length("text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, decoded=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Encoding can't be stated in SQL; tests hold the pipeline against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what each returns is written to the shared checkpoint folder and read again. A
    stage's rows are removed once the next stage's are written; the last stage's stay, as the result reads them."""
    folder, before = folder_in(spark, f"pipeline-{uuid.uuid4().hex}"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
