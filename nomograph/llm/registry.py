"""The corpus operators' queries and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nomograph.llm import bpe, conversations, cover_tree, heap_lloyd, html_extract, kmeans_tree, langid, minhash, mixing, pii, rules, secrets, weak_quality

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_cover_tree": cover_tree.op2_cover_tree,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_mixing": mixing.op4_mixing,
    "op5_weak_quality": weak_quality.op5_weak_quality,
    "op6_minhash": minhash.op6_minhash,
    "op7_page_text": html_extract.op7_page_text,
    "op8_language": langid.op8_language,
    "op9_quality_rules": rules.op9_quality_rules,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_kmeans_tree": kmeans_tree.op11_kmeans_tree,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_heap_lloyd": heap_lloyd.op13_heap_lloyd,
}
ORACLE_SQL: dict[str, str] = {"op2_cover_tree": cover_tree.OP2_SQL, "op6_minhash": minhash.OP6_SQL, "op4_mixing": mixing.OP4_SQL, "op9_quality_rules": rules.OP9_SQL, "op10_secret_scan": secrets.OP10_SQL, "op13_heap_lloyd": heap_lloyd.OP13_SQL}
