"""Quality classifier on supervised subword embeddings.

A text is the mean of learned vectors: one per word, per character n-gram of a
word, and for each word that repeats the one before (hashed into ``BUCKETS``
rows). A softmax layer reads the two classes from the mean.
Vectors and layer are trained together by numpy stochastic gradient descent on
a bounded sample of labelled documents (``SAMPLE``, those with the least hash
of their id).

The layer is linear after the mean, so a trained model is one number per
bucket; a word's sum over its n-grams is computed once and remembered. All
documents are scored in one pass without a shuffle.
"""

from __future__ import annotations

import functools
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map
from panelcast.llm.toxicity import fold, learned_texts

SAMPLE = 2500
BUCKETS = 1 << 18
NGRAMS = (3, 4)
DIM, EPOCHS, RATE = 8, 8, 0.5
SEED = 11
WORD_CACHE = 800_000
#: characters of a word whose n-grams are used; what lies beyond counts in further parts of this length
WORD_PART = 64


#: row of the bigram of a word with itself
REPEAT = zlib.crc32(b"< = >") % BUCKETS


def word_buckets(word: str) -> list[int]:
    """Rows of a word and of the n-grams of ``<word>``; a longer word is taken in parts."""
    if len(word) > WORD_PART:
        return [b for i in range(0, len(word), WORD_PART) for b in word_buckets(word[i : i + WORD_PART])]
    marked = f"<{word}>"
    if word.isascii():
        raw = marked.encode()
        grams = {raw, *(raw[i : i + n] for n in NGRAMS for i in range(len(raw) - n + 1))}
    else:
        grams = {g.encode() for g in (marked, *(marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)))}
    return [g % BUCKETS for g in map(zlib.crc32, grams)]


def repeats(words: list[str]) -> int:
    """Words that equal the one before: a word bigram of its own, whatever the word."""
    return sum(map(operator.eq, words, words[1:]))


def text_buckets(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a whole text, ascending, and their shares (adding up to 1)."""
    counts: Counter[int] = Counter()
    words = (text or "").split()
    if again := repeats(words):
        counts[REPEAT] = again
    for word, n in Counter(words).items():
        for b in word_buckets(word):
            counts[b] += n
    rows = np.array(sorted(counts), "<i4")
    share = np.array([counts[r] for r in rows.tolist()], "<f4")
    return rows, share / max(1.0, float(share.sum()))


@dataclass
class QualityModel:
    slopes: np.ndarray  # per bucket: what its vector adds to the log odds of label 1
    bias: float


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> QualityModel:
    """Train vectors and softmax layer; a sample of one class, or none, gives that class's share alone."""
    y = np.array(labels, int)
    if len(y) == 0 or y.min() == y.max():
        return QualityModel(np.zeros(BUCKETS), 0.0 if len(y) == 0 else 4.0 * (2 * int(y[0]) - 1))
    rng = np.random.default_rng(SEED)
    vectors = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    layer = np.zeros((2, DIM), np.float32)
    bias = np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    total, done = EPOCHS * len(y), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)).tolist():
            rows, share = texts[i]
            rate = RATE * (1 - done / total)
            done += 1
            if not len(rows):
                continue
            hidden = share @ vectors[rows]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            slope = p / p.sum()
            slope[y[i]] -= 1
            to_hidden = slope @ layer
            layer -= rate * np.outer(slope, hidden)
            bias -= 0.1 * rate * slope
            # shares are small: rows move by their share of the text's mass relative to an even one
            vectors[rows] -= rate * np.outer(share * min(len(rows), 64), to_hidden)
    return QualityModel((vectors @ (layer[1] - layer[0])).astype(float), float(bias[1] - bias[0]))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_buckets(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([r.tobytes() for r, _ in found], pa.binary()),
            pa.array([s.tobytes() for _, s in found], pa.binary())], ["quality", "rows", "shares"])


class _WordSums(dict):
    """Place of a word in two arrays: sum of its buckets' slopes, and number of buckets."""

    def __init__(self, slopes: np.ndarray):
        super().__init__()
        self.slopes = slopes.tolist()
        self.sums = np.zeros(WORD_CACHE)
        self.counts = np.zeros(WORD_CACHE)

    def __missing__(self, word: str) -> int:
        buckets = word_buckets(word)
        at = self[word] = len(self)
        if at >= len(self.sums):  # within one very long text
            self.sums, self.counts = np.append(self.sums, np.zeros(at)), np.append(self.counts, np.zeros(at))
        self.sums[at] = sum(map(self.slopes.__getitem__, buckets))
        self.counts[at] = len(buckets)
        return at

    def forget(self) -> None:
        self.clear()
        self.sums, self.counts = np.zeros(WORD_CACHE), np.zeros(WORD_CACHE)


def score_texts(model: QualityModel, words: _WordSums, texts: list[str | None]) -> np.ndarray:
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        parts = (text or "").split()
        if len(words) + len(parts) > WORD_CACHE:
            words.forget()
        at = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
        again = repeats(parts)
        whole = words.sums[at].sum() + again * words.slopes[REPEAT]
        mean = whole / (words.counts[at].sum() + again) if parts else 0.0
        out[i] = 1 / (1 + np.exp(-np.clip(mean + model.bias, -30, 30)))
    return out


_remembered: dict[int, _WordSums] = {}


def _words_of(model: QualityModel) -> _WordSums:
    """One memory of words per worker process and model; it outlives a task."""
    key = zlib.crc32(model.slopes.tobytes())
    if key not in _remembered:
        _remembered.clear()
        _remembered[key] = _WordSums(model.slopes)
    return _remembered[key]


def _score_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    words = _words_of(model)
    for batch in batches:
        scores = score_texts(model, words, batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])


def train(docs: DataFrame, labels: DataFrame, held_out_fold: int = 0, folds: int = 5) -> QualityModel:
    """Fit on labelled documents outside the held-out fold.

    Rows without an id or a label are not learned from; a repeated id is one document with the smallest of its
    texts, and of several labels the largest counts. Empty tables give a model that scores 0.5.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    known = known.where(fold("doc_id", folds) != held_out_fold)
    sample = known.orderBy(F.xxhash64("doc_id")).limit(SAMPLE)  # at most SAMPLE ids
    texts = learned_texts(docs, sample)
    rows = arrow_map(texts.select(F.col("quality").cast("int"), "text"), _feature_batches,
                     "quality int, rows binary, shares binary").toArrow()
    found = sorted(zip(*(rows.column(c).to_pylist() for c in ("rows", "shares", "quality")), strict=True))
    return fit([(np.frombuffer(r, "<i4"), np.frombuffer(s, "<f4")) for r, s, _ in found], [q for *_, q in found])


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row: the softmax share of label 1, in (0, 1).

    Null and empty texts get the share that the layer's bias gives. Other
    columns are not read; repeated rows and rows without an id stay.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    return arrow_map(slim, functools.partial(_score_batches, model=shared), "doc_id long, score double")
