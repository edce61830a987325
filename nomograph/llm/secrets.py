"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a document is addressed by the SHA-256 of its text, its blob. A ledger keeps the findings
of each (blob, rule version) pair that was ever scanned. A scan computes the blobs of the given versions,
takes the pairs that the ledger lacks, scans one copy of each such blob, adds the findings to the ledger,
and joins them back to every path (here: row) that holds the blob.

Spans are code point offsets, end exclusive. Positions of all matches come from split(): the pieces between
the matches and the matches themselves, in turn, make up the text, so a running sum of lengths gives offsets. The sum
is a window over a text's matches (rows of a few numbers), so that a text with very many takes no longer for each.

Defined cases: a null text counts as empty; repeated rows each get the findings; an empty table gives an
empty result; a text of any length, with any number of matches, is scanned whole in time proportional to both; other
columns are ignored by findings_of and passed through by redact.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import checkpoint_dir, cut, exists, folder_in, pick, remove, table

#: kind -> (pattern, a quick test without which the pattern can't match, least length of the group or match, group).
#: Run lengths are in the pattern where the whole run is the match; assign drops short values after matching.
RULES: dict[str, tuple[str, str, int, int]] = {
    "assign": (r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", r"""(?:[dDtTnNyY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""", 8, 2),
    "access": (r"AKIA[A-Z0-9]{12,}", r"AKIA[A-Z0-9]{12}", 16, 0),
    "hex": (r"[0-9a-f]{32,}", r"[0-9a-f]{32}", 32, 0),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "forge": (r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}", 0, 0),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}", 0, 0),
}
#: The same matches by a pattern that reads a run once: (pattern, least length of the group, group). A plain one would start
#: anew at each eyJ of a run; only the first can match, so the second branch takes the rest of the run, and its group is empty.
LINEAR: dict[str, tuple[str, int, int]] = {"jwt": (r"(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)|eyJ[A-Za-z0-9_-]*+", 1, 1)}
BASE = ("assign", "access", "hex")
#: Names the rules above in the ledger; a change of rules takes a new version, and old blobs are scanned again.
RULE_VERSION = "1.1"
#: The session's setting that names a ledger to keep between runs. Without it a run's ledger is its own.
LEDGER = "spark.nomograph.ledger"
#: Findings are broadcast up to so many spans (each under a hundred bytes); beyond, rows are joined by blob and salt.
BROADCAST_SPANS = 20_000
SALTS = 8
#: Rows of blobs are broadcast up to this many, each of some hundred bytes.
BROADCAST_ROWS = 20_000
#: s and e: code points; start and end: the same in bytes; at: the greatest end, in bytes, of the spans before.
SPAN = "array<struct<s:int,rank:int,kind:string,e:int,start:int,end:int,at:int>>"
FOUND = f"blob string, rule_version string, spans {SPAN}"


def _none() -> Column:
    return F.array().cast(SPAN)


def _steps(text: Column, kind: str) -> Column:
    """For each match of the kind's pattern the piece before it, the match and its group, as lengths; null without a match."""
    pattern, quick, least, group = RULES[kind]
    pattern, least, group = LINEAR.get(kind, (pattern, least, group))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("bytes")))
    sizes = F.transform(hits, lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("bytes")))
    kept = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x) >= least) if group else F.transform(hits, lambda x: F.length(x) >= least)
    return F.when(text.rlike(quick), F.arrays_zip(pieces.alias("piece"), sizes.alias("hit"), kept.alias("good")))


def likely(text: Column) -> Column:
    """False only for texts without findings."""
    return reduce(Column.__or__, [text.rlike(quick) for _, quick, _, _ in RULES.values()])


def scan(blobs: DataFrame) -> DataFrame:
    """blobs: blob, text. blob and spans, sorted, of the blobs with findings. Rows of one blob must agree."""
    kinds = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(kind).alias("kind"), _steps(F.col("text"), kind).alias("steps")) for k, kind in enumerate(RULES)])
    # outer, and filtered afterwards: a filter before it would evaluate the patterns twice
    rows = blobs.where(likely(F.col("text"))).select("blob", F.explode_outer(kinds).alias("k")).select("blob", "k.*").where(F.col("steps").isNotNull())
    one = rows.repartition("blob").groupBy("blob", "rank", "kind").agg(F.any_value("steps").alias("steps"))
    each = one.select("blob", "rank", "kind", F.posexplode("steps").alias("i", "x")).where(F.col("x.hit").isNotNull())
    upto = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = [F.sum(F.col(f"x.piece.{n}") + F.col(f"x.hit.{n}")).over(upto).cast("int").alias(name) for n, name in (("n", "e"), ("bytes", "end"))]
    placed = each.select("blob", "rank", "kind", "x", *ends).where("x.good")
    placed = placed.select("blob", (F.col("e") - F.col("x.hit.n")).alias("s"), "rank", "kind", "e", (F.col("end") - F.col("x.hit.bytes")).alias("start"), "end")
    before = Window.partitionBy("blob").orderBy("s", "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("s", "rank", "kind", "e", "start", "end", "at"))).cast(SPAN).alias("spans"))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def found_in(rows: DataFrame, found: DataFrame, key: Column) -> DataFrame:
    """rows with the _spans of their blob, key; null without. found: blob, spans, one row for each blob; checkpointed. A blob may hold any share of the rows."""
    found = found.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
    if (found.agg(F.sum(F.size("_spans"))).first()[0] or 0) <= BROADCAST_SPANS:
        return rows.join(F.broadcast(found), key == F.col("_blob"), "left").drop("_blob")
    salted = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")  # any salt of a row gives the same result
    return rows.withColumn("_own", salt).join(salted, (key == F.col("_blob")) & (F.col("_own") == F.col("_salt")), "left").drop("_blob", "_salt", "_own")


def findings_of(versions: DataFrame, ledger: str | None = None) -> DataFrame:
    """versions: doc_id, text, one row for each path or historical version. doc_id, blob, spans of every row.

    ledger: a folder of findings (Parquet), read if it exists and extended by what this call scans; None stands for the
    session's setting LEDGER, and without that for a new folder in the shared one, removed when its findings are read. Texts of unseen blobs are shuffled once,
    to meet one copy of each; in a first scan, where all are unseen, only those that a quick test lets pass."""
    spark = versions.sparkSession
    kept = ledger or spark.conf.get(LEDGER, None)
    ledger = kept or folder_in(spark, f"ledger-{uuid.uuid4().hex}")
    rows = pick(versions, "doc_id", "text")
    paths = rows.select("doc_id", blob_of(F.col("text")).alias("blob"))
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    known = exists(spark, ledger)
    if known:
        seen = spark.read.schema(FOUND).parquet(ledger).where(F.col("rule_version") == RULE_VERSION)
        unseen = unseen.join(seen.select("blob"), "blob", "left_anti")
    unseen = cut(unseen.withColumnRenamed("doc_id", "_doc").withColumnRenamed("blob", "_blob"))
    small = unseen.count() <= BROADCAST_ROWS
    one_copy = (  # joined by blob and row, so that the copies of one text part
        rows.where(F.length("text") > 0)
        .withColumn("blob", blob_of(F.col("text")))
        .join(F.broadcast(unseen) if small else unseen.hint("shuffle_hash"), (F.col("blob") == F.col("_blob")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
        .select("blob", "text")
    )
    if known:  # the scan's quick test stays behind the join, so that seen texts aren't read by patterns; in a first scan it goes before it
        one_copy = one_copy.withColumn("_n", F.monotonically_increasing_id()).where("_n >= 0").drop("_n")
    fresh = cut(scan(one_copy))
    entries = found_in(unseen.select(F.col("_blob").alias("blob")), fresh, F.col("blob"))
    entries.select("blob", F.lit(RULE_VERSION).alias("rule_version"), F.coalesce("_spans", _none()).alias("spans")).write.mode("append").parquet(ledger)
    found = spark.read.schema(FOUND).parquet(ledger).where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0))
    found = cut(found.select("blob", "spans").dropDuplicates(["blob"]))  # two runs at once may have scanned the same blob
    if not kept:
        remove(spark, ledger)
    return found_in(paths, found, F.col("blob")).select("doc_id", "blob", F.coalesce("_spans", _none()).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digest(found: DataFrame) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE]  # noqa: B023  filter calls it at once
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """docs with every finding replaced by <kind>; overlapping findings merge under the first one's kind. All rows
    and columns stay. Texts are cut by bytes, each byte once."""
    found = cut(findings_of(docs, ledger).where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"]))
    row, spans = F.col("_row"), F.col("_spans")  # a document's own columns, whatever their names

    def without(data: Column) -> Column:
        part = lambda start, end: F.substring(data, start + 1, end - start).cast("string")
        heads = F.transform(F.filter(spans, lambda x: x["start"] >= x["at"]), lambda x: F.concat(part(x["at"], x["start"]), F.lit("<"), x["kind"], F.lit(">")))
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(heads, ""), part(last, F.octet_length(data)))

    data = F.transform(F.array(row["text"].cast("binary")), without)  # the text's bytes are made once
    new = F.when(spans.isNull(), row["text"]).otherwise(F.get(data, F.lit(0)))
    own = [(new if c == "text" else row[c]).alias(c) for c in docs.columns]
    return found_in(docs.select(F.struct("*").alias("_row")), found, blob_of(row["text"])).select(*own)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    return digest(findings_of(table(spark, sf_dir, "documents")))


def _kind_sql(rank: int, kind: str) -> str:
    pattern, _, least, group = RULES[kind]
    p = pattern.replace("'", "''")
    return f"""SELECT rid, {rank} AS rank, '{kind}' AS kind, CAST(list_sum(list_transform(ps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0) AS BIGINT) AS s, length(m[k]) AS n
  FROM (SELECT rid, m, v, ps, unnest(range(1, len(m) + 1)) AS k FROM (
    SELECT rid, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS v, regexp_split_to_array(t, '{p}') AS ps FROM d WHERE regexp_matches(t, '{p}'))) WHERE length(v[k]) >= {least}"""


OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_kind_sql(i, k) for i, k in enumerate(RULES))}),
g AS (SELECT rid, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) AS spans, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) FILTER (rank < {len(BASE)}) AS base,
  {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)} FROM f GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)
"""
