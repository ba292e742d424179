"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents (positives) and unlabelled text are learned
from; a label of 0 is never used as a negative. With class prior ``pi`` the
risk of a scorer ``g`` is ``pi * E_p[l(g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)])``
for the logistic loss ``l``; when the second term falls below zero, its
gradient is followed upwards instead, so that the scorer cannot learn the
unlabelled toxic documents by heart. Features are the words of a text and their
beginnings; a document has a feature or has it not, so a long clean text does
not hide a toxic passage.

The model is fitted by numpy on a bounded sample (``POSITIVES`` and
``UNLABELLED`` documents, those with the least hash of their id). All
documents are scored in one pass without a shuffle.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map

POSITIVES, UNLABELLED = 3000, 6000
#: beginnings of words that are features, in characters
PREFIXES = (3, 4, 5, 6, 7, 8)
#: a feature must occur in so many positives, and so many times oftener there than in unlabelled text
LEAST_POSITIVES, LEAST_LIFT = 4, 10.0
FEATURES = 20_000
#: distinct features of a text that is learned from: those with the smallest hashes
TEXT_FEATURES = 50_000
#: the decay is the one of 1e-5, 3e-5, 1e-4, 3e-4 with the fewest errors at 0.7 in three-fold cross-validation inside
#: the training folds of check_s (120, 32, 13 and 21 among 1,444 toxic and 6,000 clean documents)
STEPS, RATE, DECAY = 400, 0.05, 1e-4
WORD_CACHE = 500_000
_STRIP = ".,;:!?\"'()[]{}*%$&#|<>-_"


def word_features(word: str) -> list[int]:
    """Hashes of a word (lower case, punctuation stripped) and its beginnings."""
    word = word.lower().strip(_STRIP)
    if not word:
        return []
    return [zlib.crc32(f"={word}".encode()), *(zlib.crc32(word[:n].encode()) for n in PREFIXES if len(word) >= n)]


def text_features(text: str | None) -> np.ndarray:
    """The distinct feature hashes of a whole text, ascending."""
    found = {f for w in set((text or "").split()) for f in word_features(w)}
    return np.array(sorted(found), "<u4")


@dataclass
class ToxicityModel:
    features: np.ndarray  # ascending hashes
    weights: np.ndarray
    bias: float


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> ToxicityModel:
    """Fit on feature sets of positives and of unlabelled texts."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return ToxicityModel(np.zeros(0, "<u4"), np.zeros(0), -5.0)
    hashes, in_positive = np.unique(np.concatenate(positive), return_counts=True)
    others, in_others = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(others, hashes), max(0, len(others) - 1))
    among = np.where(others[at] == hashes, in_others[at], 0) if len(others) else np.zeros(len(hashes))
    p_rate, u_rate = in_positive / len(positive), among / len(unlabelled)
    # unlabelled text holds the share ``prior`` of positives
    clean_rate = np.maximum((u_rate - prior * p_rate) / (1 - prior), 0.5 / len(unlabelled))
    lift = p_rate / clean_rate
    usable = np.flatnonzero((in_positive >= LEAST_POSITIVES) & (lift >= LEAST_LIFT))
    order = np.lexsort((hashes[usable], -p_rate[usable] * np.log(lift[usable])))
    features = np.sort(hashes[usable[order[:FEATURES]]])
    model = ToxicityModel(features, np.zeros(len(features)), float(np.log(prior / (1 - prior))))
    if not len(features):
        return model

    texts = [*positive, *unlabelled]
    rows, cols = [], []
    for i, held in enumerate(texts):
        place = np.minimum(np.searchsorted(features, held), len(features) - 1)
        place = place[features[place] == held]
        rows.append(np.full(len(place), i))
        cols.append(place)
    row, col = np.concatenate(rows), np.concatenate(cols)
    n_p = len(positive)
    sign_p = np.arange(len(texts)) < n_p
    size = np.where(sign_p, n_p, len(unlabelled)).astype(float)
    first, second = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, STEPS + 1):
        g = model.bias + np.bincount(row, model.weights[col], len(texts))
        up = 1 / (1 + np.exp(-np.clip(g, -30, 30)))  # derivative of l(-g); that of l(g) is up - 1
        negative_risk = (np.logaddexp(0, g[~sign_p]).mean() - prior * np.logaddexp(0, g[sign_p]).mean())
        by_negative = np.where(sign_p, -prior * up, up) / size
        by_positive = np.where(sign_p, prior * (up - 1), 0.0) / size
        slope = by_positive + by_negative if negative_risk >= 0 else -by_negative
        grad = np.append(np.bincount(col, slope[row], len(features)) + DECAY * model.weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= float(move[-1])
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [text_features(t.as_py())[:TEXT_FEATURES].tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["positive", "features"])


class _WordScores(dict):
    """The model's features (places) that a word has; most words have none."""

    def __init__(self, features: np.ndarray):
        super().__init__()
        self.places = {h: i for i, h in enumerate(features.tolist())}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = tuple(self.places[f] for f in word_features(word) if f in self.places)
        return value


def score_texts(model: ToxicityModel, cache: _WordScores, texts: list[str | None]) -> np.ndarray:
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        held = set().union(*filter(None, map(cache.__getitem__, (text or "").split())))
        g = model.bias + float(model.weights[sorted(held)].sum()) if held else model.bias
        out[i] = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    return out


def _score_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    cache = _WordScores(model.features)
    for batch in batches:
        scores = score_texts(model, cache, batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])


def fold(id_col: str, folds: int):
    """``crc32(id as text) mod folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def learned_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The columns of ``sample`` (a bounded number of rows, with ``doc_id``) and ``text``: of several rows of an id the
    smallest text, so a repeated id is one row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    texts = ids.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")


def train(docs: DataFrame, labels: DataFrame, held_out_fold: int = 1, folds: int = 3) -> ToxicityModel:
    """Fit on documents outside the held-out fold.

    The class prior is the share of toxic rows among all labelled ones
    outside that fold. A repeated id is one document with the smallest of its texts;
    of several labels the largest counts. Documents of a label table without positives, or empty
    tables, give a model that scores all texts low. The driver gets at most ``POSITIVES + UNLABELLED``
    rows of at most ``TEXT_FEATURES`` hashes.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(fold("doc_id", folds) != held_out_fold)
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    positives = known.where("toxic = 1").orderBy(F.xxhash64("doc_id")).limit(POSITIVES)
    unlabelled = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").where(
        fold("doc_id", folds) != held_out_fold).distinct()
    unlabelled = unlabelled.orderBy(F.xxhash64("doc_id")).limit(UNLABELLED)
    sample = positives.select("doc_id", F.lit(True).alias("positive")).unionByName(
        unlabelled.select("doc_id", F.lit(False).alias("positive")))
    texts = learned_texts(docs, sample).select("positive", "text")
    rows = arrow_map(texts, _feature_batches, "positive boolean, features binary").toArrow()
    sets = [np.frombuffer(x, "<u4") for x in rows.column("features").to_pylist()]
    flags = rows.column("positive").to_pylist()
    order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())  # independent of the partitions' order
    return fit_nnpu([sets[i] for i in order if flags[i]], [sets[i] for i in order if not flags[i]], prior)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row; scores are in (0, 1), higher for toxic text.

    Null and empty texts have no feature and get the model's score for that.
    Other columns are not read; repeated rows and rows without an id stay.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights
    return arrow_map(slim, functools.partial(_score_batches, model=shared), "doc_id long, score double")


def _clean_batches(batches: Iterator[pa.RecordBatch], model, place: int, threshold: float) -> Iterator[pa.RecordBatch]:
    model = model.value
    cache = _WordScores(model.features)
    for batch in batches:
        scores = score_texts(model, cache, batch.column(place).to_pylist())
        yield batch.filter(pa.array(scores < threshold))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) whose own text scores below ``threshold``.

    Each row is judged by itself, with or without an id, also where ids repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))  # at most FEATURES weights
    step = functools.partial(_clean_batches, model=shared, place=docs.columns.index("text"), threshold=threshold)
    return arrow_map(docs, step, docs.schema)
