"""Quality rules as a short-circuit cascade.

Each rule rejects a text. A sample of the corpus gives every rule's cost (seconds a text) and its rejection
rate; rules then run in descending order of rejections per second and stop at the first that rejects. The
verdict is a conjunction, so it depends on no order, and reruns agree; only the work does.

Defined cases: a null text counts as empty and is rejected (too few words); repeated rows are judged alike;
an empty table gives an empty result; columns other than doc_id and text are ignored by quality_features
and passed through by keep_good.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm.common import SPACE, hash_share, no_table, pick, small_batches, table, utf8

#: Documents on which costs and rejection rates are estimated; the verdicts don't depend on it.
SAMPLE_ROWS = 400
SYMBOLS = b"#*$%&|<>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = SPACE.encode()


class Text:
    """One text's features, each computed when a rule first asks for it."""

    __slots__ = ("raw", "_words", "_repeat", "_lines")

    def __init__(self, raw: bytes | None):
        self.raw, self._words, self._repeat, self._lines = raw or b"", None, None, None

    @property
    def words(self) -> list[bytes]:
        if self._words is None:
            self._words = self.raw.split()
        return self._words

    @property
    def word_chars(self) -> int:
        return _code_points(self.raw) - sum(self.raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))

    @property
    def n_symbols(self) -> int:
        return sum(self.raw.count(bytes([c])) for c in SYMBOLS)

    def _count_lines(self) -> tuple[int, int]:
        if self._lines is None:
            lines = [x for x in self.raw.split(b"\n") if x.strip(_SPACE)]
            self._lines = len(lines), len(lines) - len(set(lines))
        return self._lines

    @property
    def n_lines(self) -> int:
        return self._count_lines()[0]

    @property
    def n_dup_lines(self) -> int:
        return self._count_lines()[1]

    @property
    def n_repeat_words(self) -> int:
        if self._repeat is None:
            self._repeat = repeated_words(self.words)
        return self._repeat


def _code_points(raw: bytes) -> int:
    if raw.isascii():
        return len(raw)
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur at least twice in the text, the first occurrence included."""
    n = len(words) - 4
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        key = h[:n].copy()
        for k in range(1, 5):
            key *= _MIX
            key ^= key >> np.uint64(29)
            key += h[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + 5, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


_LETTER, _UPPER = re.compile(rb"[A-Za-z]+"), re.compile(rb"[A-Z]+")


def _shouting(t: Text) -> bool:
    letters = sum(map(len, _LETTER.findall(t.raw)))
    return letters >= 20 and 100 * sum(map(len, _UPPER.findall(t.raw))) > 80 * letters


#: name -> test that is true for a text to reject. The first two are the base rules.
RULES: dict[str, Callable[[Text], bool]] = {
    "few_words": lambda t: len(t.words) < 10,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 20 * len(t.words),
    "symbols": lambda t: 100 * t.n_symbols > 25 * len(t.words),
    "repeated_lines": lambda t: 100 * t.n_dup_lines > 30 * t.n_lines,
    "short_words": lambda t: 10 * t.word_chars < 20 * len(t.words),
    "long_words": lambda t: t.word_chars > 20 * len(t.words),
    "shouting": _shouting,
}


def trial(sample: list[bytes | None], rules: dict[str, Callable[[Text], bool]] = RULES) -> list[tuple[str, int, float]]:
    """For each rule how many texts it rejects, and the seconds that this takes. A rule pays for the features that it needs, so each has its texts anew."""
    found = []
    for name, rejects in rules.items():
        texts = [Text(x) for x in sample]
        began = time.perf_counter()
        hits = sum(map(rejects, texts))
        found.append((name, hits, time.perf_counter() - began))
    return found


def order_rules(found: list[tuple[str, int, float]], rules: dict[str, Callable[[Text], bool]] = RULES) -> list[str]:
    """Rule names by estimated rejections per second, the best first; ties and an empty sample keep the given order. found: trials, any number a rule."""
    hits, seconds = dict.fromkeys(rules, 0), dict.fromkeys(rules, 1e-9)
    for name, n, took in found:
        hits[name] += n
        seconds[name] += took
    return sorted(rules, key=lambda name: -hits[name] / seconds[name])


def sampled_order(docs: DataFrame) -> list[str]:
    """The order by a sample of about SAMPLE_ROWS rows from all of docs, drawn by hash and tried where it lies: only sums reach the driver."""
    small_batches(docs.sparkSession)
    share = SAMPLE_ROWS / max(1, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            columns = list(zip(*trial(utf8(batch.column(0))), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rule", "hits", "seconds"])

    some = pick(docs, "doc_id", "text").where(hash_share("doc_id", F.length("text"), F.lit(9)) < share).select("text")
    tried = some.mapInArrow(run, "rule string, hits long, seconds double").groupBy("rule").agg(F.sum("hits"), F.sum("seconds"))
    return order_rules([tuple(r) for r in tried.collect()])


def passes(text: Text, order: list[str]) -> bool:
    return not any(RULES[name](text) for name in order)


def quality_features(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every row."""
    small_batches(docs.sparkSession)
    order = [x for x in sampled_order(docs) if x not in ("few_words", "repeated_windows")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            rows = []
            for raw in utf8(batch.column(1)):
                t = Text(raw)
                n = len(t.words)
                failed = n < 10 or 100 * t.n_repeat_words > 20 * n
                rows.append((n, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, not failed and passes(t, order)))
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.bool_()) for c in cols[5:]]],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose text no rule rejects. One narrow pass, no shuffle."""
    small_batches(docs.sparkSession)
    order, at = sampled_order(docs), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            yield batch.filter(pa.array([passes(Text(x), order) for x in utf8(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_features(table(spark, sf_dir, "documents"))


_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_W} AS w FROM documents
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM (
    SELECT rid, i, array_to_string(w[i:i+4], ' ') AS k
    FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, i + unnest([0, 1, 2, 3, 4]) AS p FROM win WHERE c >= 2) GROUP BY rid
), ln AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), f AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 25 * n_words OR 100 * n_dup_lines > 30 * n_lines
    OR 10 * word_chars < 20 * n_words OR word_chars > 20 * n_words OR (letters >= 20 AND 100 * upper > 80 * letters)) AS kept
FROM f
"""
