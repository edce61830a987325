"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its letters: the first permuted twice,
the second once, multiplied together; runs of other characters count as one gap, which has a vector of its own.
A text's profile is the sum of its trigrams' vectors; a language's prototype is the sum over its training
texts. The language whose prototype has the greatest cosine with the text's profile is predicted, and the cosine,
not below 0, is the score.

Training reads at most about PER_LANGUAGE texts of each language, chosen by a hash of doc_id, from rows with a
language that aren't held out. Of more than MOST_LANGUAGES values of lang the commonest are learned.

Defined cases: a null text or one without letters is `und` with the score 0, as is any text if nothing could
be learned; ties go to the language first in code point order; repeated rows get equal results; an empty
table gives an empty result; texts of any length count whole; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm.common import hash_share, pick, small_batches, table, worker_table

SIZE = 1024
PER_LANGUAGE = 5000
#: Languages that are learned at most, the commonest first, so that dirty values of lang don't swell what every task holds.
MOST_LANGUAGES = 1000
SEED = 20240229
#: Trigram vectors that a worker keeps; a full table starts anew.
MOST_TRIGRAMS = 40_000
_LOW = np.uint64((1 << 21) - 1)


class Space:
    """Letters' and trigrams' vectors, made when first met."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted
        self.rows = np.empty(0, np.int64)
        self.vectors = np.empty((0, self.size), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, self.size, np.int8) * 2 - 1
        return self.letters[c]

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Codes and counts; None if the text has no letter."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(self.is_letter[c], c, 0).astype(np.uint64)
        if not c.any():
            return None
        c = np.concatenate([[np.uint64(0)], c, [np.uint64(0)]])
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # a gap counts once
        return np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:], return_counts=True)

    def matrix(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of the trigrams, a row for each."""
        at = np.minimum(np.searchsorted(self.known, codes), max(len(self.known) - 1, 0))
        new = codes[self.known[at] != codes] if len(self.known) else codes
        if len(new):
            if len(self.known) + len(new) > MOST_TRIGRAMS:
                self._clear()
                new = codes
            a, b, c = (np.stack([self.letter(int(x)) for x in part]) for part in (new >> np.uint64(42), (new >> np.uint64(21)) & _LOW, new & _LOW))
            made = np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c
            rows = np.concatenate([self.rows, np.arange(len(self.vectors), len(self.vectors) + len(new))])
            self.vectors = np.concatenate([self.vectors, made])
            self.known = np.concatenate([self.known, new])
            order = np.argsort(self.known)
            self.known, self.rows = self.known[order], rows[order]
            at = np.searchsorted(self.known, codes)
        return self.vectors[self.rows[at]]

    def profile(self, text: str | None) -> np.ndarray | None:
        found = self.trigrams(text) if text else None
        if found is None:
            return None
        codes, counts = found
        return counts.astype(np.float32) @ self.matrix(codes).astype(np.float32)


def space() -> Space:
    """One space for each worker process."""
    return worker_table("trigrams", Space)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """Languages' prototypes of unit length. Partial sums are made where the rows lie; a few numbers for each language reach the driver."""
    small_batches(docs.sparkSession)
    rows = pick(docs, "doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, PER_LANGUAGE / n))])
    chosen = rows.where(hash_share("doc_id", F.lit(7)) < F.try_element_at(share, F.col("lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                profile = space().profile(text)
                if profile is not None:
                    sums[lang] = sums.get(lang, 0) + profile.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "sums"])

    parts = chosen.select("text", "lang").mapInArrow(run, "lang string, sums array<double>")
    total = parts.select("lang", F.posexplode("sums").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {k: np.zeros(SIZE) for k in sorted({k for k in counts})}
    for lang, i, x in total.collect():
        out[lang][i] = x
    return {k: v / n for k, v in out.items() if (n := np.linalg.norm(v))}


def predict(docs: DataFrame, known: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row. Narrow: no shuffle; the prototypes are broadcast, a vector for each language."""
    small_batches(docs.sparkSession)
    names = list(known)
    shared = docs.sparkSession.sparkContext.broadcast(np.stack(list(known.values())) if known else np.empty((0, SIZE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2).to_pylist():
                profile = space().profile(text) if names else None
                norm = float(np.linalg.norm(profile)) if profile is not None else 0.0
                if not norm:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cosines = matrix @ profile / norm
                best = int(cosines.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, prototypes(docs))
