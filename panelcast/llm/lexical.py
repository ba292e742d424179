"""Ranked lexical search with norm buckets.

Scores are inner products: of an item, the vector of its terms' weights; of a
document, the vector of its impacts (saturated, length-normalised term
frequencies) on the terms of the items. Documents are kept as sparse vectors in chunks. In a
chunk the vectors are ordered by length (Euclidean norm) and cut into buckets
that double in size. For one item, from the bucket of the longest vectors on:

1. a bucket whose greatest length times the item's length is below the item's
   threshold ends the chunk (Cauchy-Schwarz; later buckets are shorter);
2. inside a bucket the item's heaviest coordinates are multiplied out and the
   rest is bounded by the lengths of the remaining parts of both vectors;
3. vectors whose bound reaches the threshold are scored again, in whole
   numbers, and may raise the threshold: the k-th best score so far.

Thresholds start at what the longest vectors of a few chunks reach, which is
a lower bound whatever chunks are taken, so no result depends on them. Each task keeps k
documents per item; Spark ranks those of all tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize

#: characters of item texts that are collected and sent to the tasks at a time
BLOCK_CHARS = 4 << 20
#: documents and term entries of a chunk; a longer document is a chunk of its own
CHUNK_DOCS = 8192
CHUNK_ENTRIES = 2 << 20
FIRST_BUCKET = 512
#: chunks whose longest vectors give the first thresholds
THRESHOLD_CHUNKS = 64
#: share of an item's squared length that its heaviest coordinates hold
FOCUS = 0.8
NO_ID = np.iinfo(np.int64).max  # rows without an id come after all others

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

CHUNK_SCHEMA = "chunk long, n_docs long, n_terms long, vectors binary"
HIT_SCHEMA = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: letters, digits and all beyond ASCII, A-Z in lower case."""
    return text.translate(_TABLE).split()


def _slices(text: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """A text in slices that end between terms."""
    at = 0
    gap = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    while len(text) - at > size:
        cut = gap.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


# -- stored vectors -----------------------------------------------------------


def _pack(number: int, ids: list[int], sizes: list[int], terms: list[np.ndarray], counts: list[np.ndarray]) -> dict:
    n = np.array(sizes, np.int64)
    ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
    head = np.array([len(ids)], np.int64)
    body = b"".join([head.tobytes(), np.array(ids, np.int64).tobytes(), n.tobytes(), ends.tobytes(),
                     np.concatenate([np.zeros(0, np.int32), *terms]).astype(np.int32).tobytes(),
                     np.concatenate([np.zeros(0, np.int32), *counts]).astype(np.int32).tobytes()])
    return {"chunk": [number], "n_docs": [int((n > 0).sum())], "n_terms": [int(n.sum())], "vectors": [zstandard.compress(body, 3)]}


@dataclass
class _Chunk:
    """Sparse vectors of some documents: ids, numbers of terms, ends of their entries, term numbers, counts."""

    ids: np.ndarray
    n: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    @classmethod
    def unpack(cls, packed: bytes) -> _Chunk:
        body = zstandard.decompress(packed)
        docs = int(np.frombuffer(body, np.int64, 1)[0])
        ids, n, ends = np.frombuffer(body, np.int64, 3 * docs, 8).reshape(3, docs)
        entries = int(ends[-1]) if docs else 0
        terms, counts = np.frombuffer(body, np.int32, 2 * entries, 8 + 24 * docs).reshape(2, entries)
        return cls(ids, n, ends, terms, counts)


def _chunks(docs: DataFrame, vocabulary: dict[bytes, int], name: str) -> DataFrame:
    """Vectors of all documents over the vocabulary, written."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = vocabulary.get
        number = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list, list] = ([], [], [], [])
        entries = 0
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0).fill_null(int(NO_ID)).to_pylist()
            for row, doc in enumerate(ids):
                found: Counter = Counter()
                size = 0
                for piece in _slices(texts[row].as_py() or b""):
                    words = terms_of(piece)
                    size += len(words)
                    found.update(words)
                pairs = [(t, c) for t, c in ((look(w), c) for w, c in found.items()) if t is not None]
                both = np.array(pairs, np.int32).reshape(-1, 2)
                for column, value in zip(held, (doc, size, both[:, 0], both[:, 1]), strict=True):
                    column.append(value)
                entries += len(both)
                if len(held[0]) == CHUNK_DOCS or entries >= CHUNK_ENTRIES:
                    yield pa.RecordBatch.from_pydict(_pack(number, *held))
                    held, entries, number = ([], [], [], []), 0, number + 1
        if held[0]:
            yield pa.RecordBatch.from_pydict(_pack(number, *held))

    rows = docs.select("doc_id", "text")
    return materialize(arrow_map(rows, step, CHUNK_SCHEMA), name)


def _frequencies(chunks: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(_Chunk.unpack(packed.as_py()).terms, minlength=size)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": term, "df": total[term]})

    parts = arrow_map(chunks.select("vectors"), step, "term long, df long")
    found = parts.groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # at most one row per term of the vocabulary
    df = np.zeros(size, np.int64)
    df[found["term"].to_numpy(np.int64)] = found["df"].to_numpy(np.int64)
    return df


# -- search in a task ---------------------------------------------------------


@dataclass
class Searcher:
    """Items as vectors of weights, and what the whole corpus says about documents."""

    items: list[np.ndarray]      # term numbers of each item
    weights: np.ndarray          # weight of each term of the vocabulary
    n_docs: int
    n_terms: int
    k: int
    floors: np.ndarray           # scores that the k-th best document of each item reaches at least

    def __post_init__(self):
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.items]
        self.focus, self.length, self.rest = [], [], []
        for terms in self.items:
            w = self.weights[terms].astype(float)
            heavy = np.argsort(-w, kind="stable")
            square = np.cumsum(w[heavy] ** 2)
            total = float(square[-1]) if len(square) else 0.0
            cut = int(np.searchsorted(square, FOCUS * total)) + 1 if total else 0
            self.focus.append(terms[heavy[:cut]])
            self.length.append(math.sqrt(total))
            self.rest.append(math.sqrt(max(0.0, total - (float(square[min(cut, len(square)) - 1]) if cut else 0.0))))
        self.dense = np.zeros(len(self.weights), np.int64)

    def impacts(self, chunk: _Chunk) -> np.ndarray:
        """Impact of each entry: 10^9 tf / (1000 tf + 20 m), rounded down."""
        n = chunk.n
        if not self.n_terms:
            return np.zeros(len(chunk.terms), np.int64)
        if len(n) and 50 * int(n.max()) * self.n_docs < 1 << 62:
            m = 50 + (50 * n * self.n_docs) // self.n_terms
        else:
            m = np.array([50 + (50 * v * self.n_docs) // self.n_terms for v in n.tolist()], np.int64)
        tf = chunk.counts.astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(chunk.ends, prepend=0)))

    def search(self, chunk: _Chunk, longest_only: bool = False) -> None:
        """Take a chunk's documents into the best of each item."""
        docs = len(chunk.ids)
        impact = self.impacts(chunk)
        doc = np.repeat(np.arange(docs), np.diff(chunk.ends, prepend=0))
        norm = np.sqrt(np.bincount(doc, impact.astype(float) ** 2, docs))
        order = np.argsort(-norm, kind="stable")  # by length
        norm, ids = norm[order], chunk.ids[order]
        rank = np.empty(docs, np.int64)
        rank[order] = np.arange(docs)
        # entries of a document, in order of length; postings of a term, in order of length
        by_doc = np.argsort(rank[doc], kind="stable")
        terms, values = chunk.terms[by_doc], impact[by_doc]
        ends = np.cumsum(np.diff(chunk.ends, prepend=0)[order])
        place = np.repeat(np.arange(docs), np.diff(ends, prepend=0))
        by_term = np.argsort(terms, kind="stable")
        post_doc, post_value = place[by_term], values[by_term].astype(float)
        post_start = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(self.weights)))])
        cuts, size = [0], FIRST_BUCKET
        while cuts[-1] < docs:
            cuts.append(min(docs, cuts[-1] + size))
            size *= 2
        if longest_only:
            cuts = cuts[:2]
        for q, focus in enumerate(self.focus):
            if not len(focus):
                continue
            spans = [(float(self.weights[t]), post_start[t], post_start[t + 1]) for t in focus.tolist()]
            for first, last in zip(cuts, cuts[1:], strict=False):
                floor = self.floor(q)
                if self.length[q] * norm[first] * (1 + 1e-9) < floor:
                    break
                part = np.zeros(last - first)
                square = np.zeros(last - first)
                for w, i, j in spans:  # a term occurs once per document: no place twice
                    i, j = i + np.searchsorted(post_doc[i:j], (first, last))
                    at = post_doc[i:j] - first
                    part[at] += w * post_value[i:j]
                    square[at] += post_value[i:j] ** 2
                bound = part + self.rest[q] * np.sqrt(np.maximum(norm[first:last] ** 2 - square, 0) + 1)
                live = first + np.flatnonzero(bound * (1 + 1e-9) + 1 >= floor)
                if len(live):
                    self.rescore(q, live, ids, ends, terms, values)

    def floor(self, q: int) -> int:
        scores = self.best[q][0]
        return max(int(self.floors[q]), int(scores[-1]) if len(scores) >= self.k else 1)

    def rescore(self, q: int, live: np.ndarray, ids: np.ndarray, ends: np.ndarray, terms: np.ndarray,
                values: np.ndarray) -> None:
        """Exact scores of the documents at places ``live``; the k best of them and those before stay."""
        size = np.diff(ends, prepend=0)[live]
        shift = np.cumsum(size) - size
        entry = np.arange(int(size.sum())) + np.repeat(ends[live] - size - shift, size)
        self.dense[self.items[q]] = self.weights[self.items[q]]
        product = self.dense[terms[entry]] * values[entry]
        self.dense[self.items[q]] = 0
        running = np.concatenate([[0], np.cumsum(product)])
        score = running[shift + size] - running[shift]
        keep = score >= self.floor(q)
        score = np.concatenate([self.best[q][0], score[keep]])
        doc = np.concatenate([self.best[q][1], ids[live][keep]])
        top = np.lexsort((doc, -score))[: self.k]
        self.best[q] = score[top], doc[top]

    def hits(self) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.items)), [len(s) for s, _ in self.best]).astype(np.int32)
        score = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in self.best)])
        doc = np.concatenate([np.zeros(0, np.int64), *(d for _, d in self.best)])
        return pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=doc == NO_ID), pa.array(score)], ["item", "doc_id", "score"])


def _hits(chunks: DataFrame, searcher: Searcher, longest_only: bool = False) -> DataFrame:
    parts = (searcher.items, searcher.weights, searcher.n_docs, searcher.n_terms, searcher.k, searcher.floors)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Searcher(*parts)
        for batch in batches:
            for packed in batch.column(0):
                own.search(_Chunk.unpack(packed.as_py()), longest_only)
        yield own.hits()

    return arrow_map(chunks.select("vectors"), step, HIT_SCHEMA)


# -- items --------------------------------------------------------------------


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list[list[str]]]]:
    """Item ids and their distinct terms, in blocks of about ``BLOCK_CHARS`` characters."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(f"({_TERM})"), F.lit(1))
    term = items.select("item_id", F.explode(found).alias("term")).distinct()
    lists = materialize(term.groupBy("item_id").agg(F.collect_list("term").alias("terms"),
                                                    F.sum(F.length("term") + 1).alias("chars")), "lexical-items")
    total = lists.agg(F.sum("chars")).first()[0] or 0
    blocks = -(-int(total) // BLOCK_CHARS)
    for b in range(blocks):
        part = lists.where(F.pmod(F.xxhash64(F.col("item_id")), F.lit(blocks)) == b) if blocks > 1 else lists
        rows = sorted(part.select("item_id", "terms").collect(), key=lambda r: (r[0] is None, r[0]))
        if rows:
            yield [r[0] for r in rows], [r[1] for r in rows]


def rank(docs: DataFrame, items: DataFrame, *, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 per item.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns,
    whatever their names, are not read. Equal scores rank by ascending doc_id, rows without a
    doc_id last. Every row of ``docs`` is a document, also if its id or text
    repeats; a null or empty text has no terms and is found by nothing. Rows of one
    item_id (null is one too) are one item with the terms of all of them; an
    item without terms, and empty tables, give no rows. Very long texts are
    split in slices. Items are collected in blocks of about 4 M characters of distinct terms,
    one pass over the documents each; statistics cover all documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    out = None
    for names, lists in _item_blocks(items):
        words = sorted({t for terms in lists for t in terms})
        number = {w.encode(): i for i, w in enumerate(words)}
        vectors = [np.array(sorted(number[t.encode()] for t in terms), np.int64) for terms in lists]
        chunks = _chunks(docs, number, "lexical-vectors")
        n_docs, n_terms, n_chunks = (int(v or 0) for v in chunks.agg(
            F.sum("n_docs"), F.sum("n_terms"), F.count("chunk")).first())
        weights = _weights(n_docs, _frequencies(chunks, len(words)))
        searcher = Searcher(vectors, weights, n_docs, n_terms, k, np.ones(len(vectors), np.int64))
        by_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        # some THRESHOLD_CHUNKS chunks, wherever they are stored
        some = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(max(1, n_chunks // THRESHOLD_CHUNKS))) == 0)
        first = _hits(some, searcher, longest_only=True)
        first = first.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") == k)
        for row in first.select("item", "score").collect():  # one row per item of the block
            searcher.floors[row["item"]] = row["score"]
        hits = _hits(chunks, searcher).withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
        known = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {_type(items)}")
        ranked = hits.join(known, "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], f"item_id {_type(items)}, rank int, doc_id long, score long")
    return out


def _type(items: DataFrame) -> str:
    return items.schema["item_id"].dataType.simpleString()


def _weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
