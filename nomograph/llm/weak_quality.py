"""Quality classifier from weak labels.

Labellers are heuristics that vote good, bad, or not at all on a text; they overlap and err. All documents' votes are
counted by pattern (there are at most 3 ** labellers, whatever the corpus), and expectation-maximisation on the
counts estimates each labeller's accuracy for good and for bad texts, and the share of good texts. The posteriors
of a bounded sample of documents then train a linear scorer on hashed features of the text, which scores every
document. A document is kept if its score is at least 0.5 and it isn't toxic.

Toxicity is learned from `labels`: a bounded sample of labelled documents, chosen by a hash of doc_id (at most about
TOXICITY_ROWS toxic and as many clean ones), trains a logistic scorer for each language on words and their beginnings.
A text is toxic if the scorer of any language says so, whatever its own lang is; a single word decides only if labels say
so. Languages with fewer than LEAST_TOXIC toxic or clean documents in the sample share one scorer. Where labels give no
scorer at all, any word of a list makes a text toxic (a parameter of Toxicity, ABUSE by default).

Defined cases: labels without a document or a toxic value are ignored, an id labelled twice is toxic if one label says so; repeated rows count once in the samples, and rows of one id are drawn by id and text; a null text counts as empty and is scored like any other; repeated rows get equal scores; an
empty table gives an empty result; texts of any length count whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomograph.llm.common import hash_share, no_table, pick, small_batches, table, utf8
from nomograph.llm.rules import SYMBOLS, Text

#: Documents whose posteriors train the scorer, chosen by a hash of doc_id.
TRAINING_ROWS = 6000
DIMENSIONS = 1 << 14
EPOCHS = 8
#: Documents of each class whose labels train the toxicity scorers, words and beginnings of words in a scorer, bytes of a beginning.
TOXICITY_ROWS = 3000
LEAST_TOXIC = 5
STARTS = 400
START_BYTES = range(4, 9)
#: English abusive words, the default of Toxicity's parameter for tables without labels.
ABUSE = frozenset("idiot idiots moron morons stupid loser losers scum worthless pathetic disgusting clown trash imbecile dumbass".encode().split())

_SHAPES = bytes(0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))
_EDGES = b".,;:!?\"'()[]{}*#$%&|<>-"


class Votes(Text):
    """A text's features for labellers and scorer."""

    __slots__ = ("_counts", "_shares", "_bare")

    def __init__(self, raw: bytes | None):
        super().__init__(raw)
        self._counts = self._shares = self._bare = None

    @property
    def counts(self) -> Counter:
        if self._counts is None:
            self._counts = Counter(self.words)
        return self._counts

    @property
    def bare(self) -> dict[bytes, int]:
        """The words in small letters without the signs around them, counted."""
        if self._bare is None:
            self._bare = {}
            for w, n in self.counts.items():
                w = w.lower().strip(_EDGES)
                self._bare[w] = self._bare.get(w, 0) + n
        return self._bare

    @property
    def shares(self) -> tuple[float, float, float, float]:
        """The shares of words of up to three bytes, that end in two symbols, in capitals, and that end a sentence; one pass tells all."""
        if self._shares is None:
            short = glued = upper = ends = 0
            for w, n in self.counts.items():
                if len(w) <= 3:
                    short += n
                elif w[-1] in SYMBOLS and w[-2] in SYMBOLS:
                    glued += n
                if w[-1] in b".?!":
                    ends += n
                if w.isupper():
                    upper += n
            size = max(1, len(self.words))
            self._shares = short / size, glued / size, upper / size, ends / size
        return self._shares


def _vote(good: bool, bad: bool) -> int:
    return 1 if good else -1 if bad else 0


#: name -> vote: 1 good, -1 bad, 0 none. A defect's absence says little, so the labellers of defects don't vote good.
LABELLERS: dict[str, Callable[[Votes], int]] = {
    "symbols": lambda t: _vote(False, t.n_symbols * 5 > len(t.words)),
    "glued": lambda t: _vote(False, t.shares[1] > 0.3),
    "bars": lambda t: _vote(False, t.counts[b"|"] * 6 > len(t.words)),
    "repetition": lambda t: _vote(False, t.n_repeat_words * 5 > len(t.words)),
    "lines": lambda t: _vote(False, t.n_dup_lines * 3 > t.n_lines),
    "few_words": lambda t: _vote(False, len(t.words) < 6),
    "capitals": lambda t: _vote(False, t.shares[2] > 0.5),
    "exclamation": lambda t: _vote(False, t.raw.count(b"!") * 8 > len(t.words)),
    "variety": lambda t: _vote(False, len(t.counts) * 10 < len(t.words)),
    "short_words": lambda t: _vote(0.15 <= t.shares[0] <= 0.65, t.shares[0] < 0.05 or t.shares[0] > 0.9),
    "full_stops": lambda t: _vote(t.shares[3] > 0.02, t.shares[3] < 0.002),
}


def pattern(t: Votes) -> int:
    """The votes as one number, a digit to base 3 for each labeller."""
    code = 0
    for vote in LABELLERS.values():
        code = code * 3 + vote(t) + 1
    return code


def votes_of(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        code, digit = divmod(code, 3)
        out.append(digit - 1)
    return out[::-1]


class LabelModel:
    """Accuracies by expectation-maximisation: for each labeller, the probability of each vote on good and on bad texts."""

    def fit(self, counts: dict[int, int], rounds: int = 200) -> LabelModel:
        votes = np.array([votes_of(c) for c in counts], np.int64).reshape(len(counts), len(LABELLERS)) + 1
        n = np.array(list(counts.values()), float)
        self.prior = 0.8
        self.table = np.empty((2, len(LABELLERS), 3))  # bad and good texts, labeller, vote
        self.table[0], self.table[1] = (0.3, 0.4, 0.3), (0.002, 0.499, 0.499)  # labellers are better than chance
        for _ in range(rounds if len(counts) else 0):
            p = self._posterior(votes)
            before = self.table.copy()
            self.prior = float(np.clip((n * p).sum() / n.sum(), 0.02, 0.98))
            for c, weight in ((0, n * (1 - p)), (1, n * p)):
                for v in range(3):
                    self.table[c, :, v] = ((votes == v) * weight[:, None]).sum(0) + 0.5
                self.table[c] /= self.table[c].sum(1, keepdims=True)
            if abs(self.table - before).max() < 1e-7:
                break
        return self

    def _posterior(self, votes: np.ndarray) -> np.ndarray:
        each = np.arange(votes.shape[1])
        bad, good = (np.log(self.table[c][each, votes]).sum(1) for c in (0, 1))
        return 1 / (1 + np.exp(np.clip(bad + np.log(1 - self.prior) - good - np.log(self.prior), -60, 60)))

    def posterior(self, codes: list[int]) -> np.ndarray:
        return self._posterior(np.array([votes_of(c) for c in codes], np.int64).reshape(len(codes), len(LABELLERS)) + 1)


_WORD, _SHAPE = zlib.crc32(b"w"), zlib.crc32(b"s")


def shapes(raw: bytes) -> Counter:
    """The words' shapes: letters small and capital, digits, signs, each run of the same as one. All of a text at once, by replacing doubles until there are none."""
    kinds = raw.translate(_SHAPES)
    for c in set(kinds):
        double = bytes([c, c])
        if double in kinds:
            kinds = kinds.replace(4 * double, double[:1]).replace(2 * double, double[:1])
        while double in kinds:
            kinds = kinds.replace(double, double[:1])
    return Counter(kinds.split())


def hashed(t: Votes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values, of unit length: words, their shapes, and the text's rates by size."""
    forms = shapes(t.raw)
    size = max(1, len(t.words))
    rates = (t.n_symbols / size, t.n_repeat_words / size, t.n_dup_lines / max(1, t.n_lines), t.word_chars / size / 10, t.raw.count(b"!") / size, len(t.counts) / size, t.shares[2])
    keys = [zlib.crc32(k, _WORD) % DIMENSIONS for k in t.bare] + [zlib.crc32(k, _SHAPE) % DIMENSIONS for k in forms]
    count = len(keys)
    values = np.log1p(np.fromiter([*t.bare.values(), *forms.values()], float, count))
    if count:
        values /= np.linalg.norm(values)
    keys += [zlib.crc32(b"r%d:%d" % (i, min(20, int(x * 20)))) % DIMENSIONS for i, x in enumerate(rates)]
    keys += [zlib.crc32(b"n%d" % size.bit_length()) % DIMENSIONS, zlib.crc32(b"bias") % DIMENSIONS]
    return np.array(keys, np.int32), np.concatenate([values, np.full(len(keys) - count, 0.5)]).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer on soft labels, by AdaGrad in a fixed order."""
    w, g2 = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-6)
    for epoch in range(EPOCHS):
        for k in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)):
            i, x = rows[k]
            grad = (1 / (1 + np.exp(-np.clip(w[i] @ x, -30, 30))) - target[k]) * x
            g2[i] += grad * grad
            w[i] -= 0.2 * grad / np.sqrt(g2[i])
    return w


def learn(docs: DataFrame) -> tuple[LabelModel, np.ndarray]:
    """The label model from all documents' votes, and the scorer's weights from the sample's posteriors."""
    small_batches(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        found: Counter = Counter()
        for batch in batches:
            found.update(pattern(Votes(x)) for x in utf8(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["code", "n"])

    counts = {r[0]: r[1] for r in rows.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n")).orderBy("code").collect()}
    model = LabelModel().fit(counts)
    share = min(1.0, TRAINING_ROWS / max(1, sum(counts.values())))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            texts = [Votes(x) for x in utf8(batch.column(1))]
            both = [hashed(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([pattern(t) for t in texts], pa.int64()), pa.array([i for i, _ in both], pa.list_(pa.int32())), pa.array([x for _, x in both], pa.list_(pa.float32()))],
                ["doc_id", "code", "i", "x"],
            )

    chosen = rows.where(hash_share("doc_id", F.xxhash64("text"), F.lit(5)) < share)
    # repeated rows count once, so that they don't swell the sample; a full order, so that reruns train alike
    sample = chosen.mapInArrow(featurise, "doc_id long, code long, i array<int>, x array<float>").dropDuplicates().toArrow()
    found = [(doc_id is None, doc_id or 0, code, i.values.to_numpy(), x.values.to_numpy()) for doc_id, code, i, x in zip(sample["doc_id"].to_pylist(), sample["code"].to_pylist(), sample["i"], sample["x"], strict=True)]
    found.sort(key=lambda r: (*r[:3], r[3].tobytes(), r[4].tobytes()))
    return model, train([r[3:] for r in found], model.posterior([r[2] for r in found]))


def starts(word: bytes) -> list[bytes]:
    """A bare word's features: itself, ended by a space, and its beginnings."""
    return [word + b" ", *[word[:k] for k in START_BYTES if k < len(word)]]


class Toxicity:
    """Logistic scorers, one for each group of labelled texts: weights of log counts of words and beginnings, and of the text's size."""

    def __init__(self, words: frozenset[bytes] = ABUSE):
        self.words = words  # any of them makes a text toxic while there is no scorer
        self.scorers: list[tuple[float, float]] = []  # weight of the size, constant
        self.weights: dict[bytes, list[tuple[int, float]]] = {}  # feature -> (scorer, weight)
        self.heads: frozenset[bytes] = frozenset()  # the features' first bytes, so that most words cost one lookup

    def fit(self, rows: list[tuple[str | None, bool, dict[bytes, int], int]]) -> Toxicity:
        """rows: language, toxic, bare words with their counts, size."""
        n = Counter((lang, toxic) for lang, toxic, _, _ in rows)
        groups: dict[str | None, list] = {}
        for row in rows:
            groups.setdefault(row[0] if min(n[row[0], False], n[row[0], True]) >= LEAST_TOXIC else None, []).append(row)
        for lang in sorted(groups, key=lambda g: (g is None, g or "")):
            self._fit(groups[lang])
        self.heads = frozenset(f[: START_BYTES[0]] for f in self.weights)
        return self

    def _fit(self, rows: list) -> None:
        toxic = np.array([r[1] for r in rows], float)
        n_toxic, n_clean = int(toxic.sum()), int((1 - toxic).sum())
        if not n_toxic or not n_clean:
            return
        in_toxic, in_clean = Counter(), Counter()
        for _, bad, words, _ in rows:  # a text's features are made anew below: those of all texts at once would fill the driver
            (in_toxic if bad else in_clean).update({f for w in words for f in starts(w)})
        gain = {f: np.log((k + 0.5) / (n_toxic + 1) * (n_clean + 1) / (in_clean[f] + 0.5)) for f, k in in_toxic.items() if k >= min(3, n_toxic)}
        names = sorted((f for f in gain if gain[f] > 1), key=lambda f: (-gain[f] * in_toxic[f], f))[:STARTS]
        at, x = {f: j for j, f in enumerate(names)}, np.ones((len(rows), len(names) + 2))
        x[:, :-2] = 0
        for k, (_, _, words, size) in enumerate(rows):
            for w, n in words.items():
                for f in starts(w):
                    if f in at:
                        x[k, at[f]] += n
            x[k, -2] = np.log1p(size) / 8
        x[:, :-2] = np.log1p(x[:, :-2])
        w, ridge = np.zeros(len(names) + 2), np.r_[np.full(len(names), 0.3), 0.01, 0.01]
        for _ in range(15):  # Newton's steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (p - toxic) + ridge * w)
        for f, weight in zip(names, w[:-2], strict=True):
            self.weights.setdefault(f, []).append((len(self.scorers), float(weight)))
        self.scorers.append((float(w[-2]), float(w[-1])))

    def n_abuse(self, t: Votes) -> int:
        """0 for a text that isn't toxic; else the uses of words that speak for it, at least 1."""
        if not self.scorers:
            return sum(n for w, n in t.bare.items() if w in self.words)
        heads, first, found, words = self.heads, START_BYTES[0], Counter(), []
        for w, n in t.bare.items():
            if (w + b" ")[:first] in heads:
                known = [f for f in starts(w) if f in self.weights]
                for f in known:
                    found[f] += n
                if known:
                    words.append((known, n))
        size = np.log1p(len(t.words)) / 8
        z = [a * size + b for a, b in self.scorers]
        for f, n in found.items():
            for k, weight in self.weights[f]:
                z[k] += weight * np.log1p(n)
        best = max(range(len(z)), key=z.__getitem__)
        if z[best] < 0:
            return 0
        return max(1, sum(n for known, n in words if any(weight > 0 for f in known for k, weight in self.weights[f] if k == best)))


def learn_toxicity(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """The scorers from the sample's labels. What is broadcast and sent to the driver is bounded by the sample."""
    small_batches(docs.sparkSession)
    known = pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic"), TOXICITY_ROWS / max(1, n.get(True, 0))).otherwise(TOXICITY_ROWS / max(1, n.get(False, 0)))
    chosen = known.where(hash_share("doc_id", F.lit(6)) < share)
    rows = pick(docs, "doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            texts = [Votes(x) for x in utf8(batch.column(3))]
            bare = [t.bare for t in texts]
            columns = [pa.array([list(b) for b in bare], pa.list_(pa.binary())), pa.array([list(b.values()) for b in bare], pa.list_(pa.int64())), pa.array([len(t.words) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2), *columns], ["doc_id", "lang", "toxic", "w", "k", "size"])

    found = rows.mapInArrow(count, "doc_id long, lang string, toxic boolean, w array<binary>, k array<long>, size long").dropDuplicates().toArrow()
    rows = {}  # a text's words may come in another order elsewhere; a full order, so that reruns train alike
    for i, lang, bad, w, k, size in zip(*[found[c] for c in ("doc_id", "lang", "toxic", "w", "k", "size")], strict=True):
        words = dict(zip(w.as_py(), k.as_py(), strict=True))
        rows[i.as_py(), lang.is_valid, lang.as_py() or "", size.as_py(), hashlib.sha256(repr(sorted(words.items())).encode()).digest()] = (lang.as_py(), bad.as_py(), words, size.as_py())
    return Toxicity().fit([rows[key] for key in sorted(rows)])


def score(docs: DataFrame, weights: np.ndarray, toxicity: Toxicity | None = None) -> DataFrame:
    """doc_id, score, n_abuse, kept of every row. Narrow: no shuffle; the weights are broadcast, their number is fixed."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((weights, toxicity or Toxicity()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        w, toxic = shared.value
        for batch in batches:
            scores, abuse = [], []
            for raw in utf8(batch.column(1)):
                t = Votes(raw)
                i, x = hashed(t)
                scores.append(float(1 / (1 + np.exp(-np.clip(w[i] @ x, -30, 30)))))
                abuse.append(toxic.n_abuse(t))
            kept = [s >= 0.5 and not a for s, a in zip(scores, abuse, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64()), pa.array(abuse, pa.int64()), pa.array(kept, pa.bool_())], ["doc_id", "score", "n_abuse", "kept"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double, n_abuse long, kept boolean")


def op5_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs)[1], learn_toxicity(docs, table(spark, sf_dir, "labels")))
