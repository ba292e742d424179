"""Benchmark decontamination: BM25 over the test items, block-max WAND, verified overlap.

The test items are the indexed collection and every training passage is a
query. BM25 impacts are divided by the item's score for its own text, so that
one threshold means the same for every item. The items are cut into blocks; a
term's largest impact in a block bounds what it can add there. For each
passage the bounds of all blocks are summed at once; blocks below the
threshold are skipped, and block-max WAND walks the postings of the others.
Every item at or above the threshold is retrieved and then verified: the
passage must hold the shingles of its question and of its answer. A long item
is retrieved by even parts, and verified as a whole around the part.

Items are indexed in groups of bounded size, one broadcast index and one pass
over the documents each, so the number of items is not limited.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize

SHINGLE = 5
OVERLAP = 0.8
#: retrieved at this share of an item's own BM25 score
THRESHOLD = 0.6
K1, B = 1.2, 0.75
#: longest run of words indexed as one item; a longer item is retrieved by parts of even length
PART_WORDS = 256
#: characters of item text per broadcast index
GROUP_CHARS = 8 << 20
#: columns of the table of block bounds
BLOCKS = 64
#: occurrences whose bounds are summed at a time
BOUND_ROWS = 1 << 18
TOKEN_CACHE = 600_000

_EDGES = re.compile(r"^\W+|\W+$")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def normalise(token: str) -> str:
    """Lower case, without punctuation at either end; may become empty."""
    word = token.lower().strip(".,!?")
    return word if word.isalnum() else _EDGES.sub("", word)


def words_of(text: str | None) -> list[str]:
    return [w for w in map(normalise, (text or "").split()) if w]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer, what precedes it the question; an item
    of one sentence is both."""
    parts = [w for w in map(words_of, _SENTENCE.split(text.strip())) if w]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ([], [])
    return [w for p in parts[:-1] for w in p], parts[-1]


def shingles(words: list[int]) -> set[tuple[int, ...]]:
    """Runs of ``SHINGLE`` words; fewer words make one run."""
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def part_edges(n_words: int) -> list[int]:
    """Where the parts begin by which an item is retrieved, and its end."""
    parts = -(-n_words // PART_WORDS)
    return [n_words * i // parts for i in range(parts + 1)]


@dataclass
class Statistics:
    """What all items say: number of indexed parts, their mean length, the longest one, and in how many parts
    a word occurs (for the words of one group of items)."""

    parts: int
    mean: float
    longest: int
    held: dict[str, int]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Statistics:
        held, lengths = Counter(), []
        for _, text in items:
            if words := words_of(text):
                edges = part_edges(len(words))
                for start, stop in zip(edges[:-1], edges[1:], strict=True):
                    lengths.append(stop - start)
                    held.update(set(words[start:stop]))
        return cls(len(lengths), sum(lengths) / max(1, len(lengths)), max([0, *lengths]), dict(held))


class ItemIndex:
    """Inverted index of one group of items with block bounds.

    ``items`` are ``(item_id, text)``. Items without words are left out. ``statistics`` are those
    of all items, of which these may be some.
    """

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None):
        statistics = statistics or Statistics.of(items)
        self.terms: dict[str, int] = {}
        self.item_ids: list[int] = []
        self.checks: list[tuple[frozenset, frozenset]] = []
        self.spans: list[tuple[int, int] | None] = []  # of a part: its place in its item, and the item's words
        texts: list[list[int]] = []
        for item_id, text in items:
            question, answer = question_and_answer(text or "")
            words = words_of(text)
            if not words:
                continue
            both = tuple(frozenset(shingles([self._term(w) for w in x])) for x in (question, answer))
            edges = part_edges(len(words))
            parts = len(edges) - 1
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                texts.append([self._term(w) for w in words[start:stop]])
                self.item_ids.append(item_id)
                self.checks.append(both)
                self.spans.append((start, len(words)) if parts > 1 else None)
        self.tile = max(SHINGLE, statistics.longest)
        self._impacts(texts, statistics)

    def _term(self, word: str) -> int:
        return self.terms.setdefault(word, len(self.terms))

    def _impacts(self, texts: list[list[int]], statistics: Statistics) -> None:
        n, every, mean = len(texts), statistics.parts, statistics.mean
        held = [statistics.held.get(word, 0) for word in self.terms]
        # items that share their commonest term stand together: blocks of one language bound tighter
        order = sorted(range(n), key=lambda i: (max(set(texts[i]), key=lambda t: (held[t], t)), i))
        self.item_ids = [self.item_ids[i] for i in order]
        self.checks = [self.checks[i] for i in order]
        self.spans = [self.spans[i] for i in order]
        self.block = max(1, math.ceil(n / BLOCKS))
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in self.terms]
        self.bounds = np.zeros((len(self.terms), max(1, math.ceil(n / self.block))), np.float32)
        for at, i in enumerate(order):
            counts = Counter(texts[i])
            length = K1 * (1 - B + B * len(texts[i]) / mean)
            parts = {t: math.log(1 + (every - held[t] + 0.5) / (held[t] + 0.5)) * f * (K1 + 1) / (f + length)
                     for t, f in counts.items()}
            whole = sum(parts.values())
            block = at // self.block
            for t, x in parts.items():
                self.postings[t].setdefault(block, []).append((at, x / whole))
                self.bounds[t, block] = max(self.bounds[t, block], x / whole)

    def block_max_wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """All items of ``block`` whose score for the query is at least ``threshold``."""
        lists = [(p, float(self.bounds[t, block])) for t in terms if (p := self.postings[t].get(block))]
        at = [0] * len(lists)
        live = list(range(len(lists)))
        found = []
        while live:
            live.sort(key=lambda j: lists[j][0][at[j]][0])
            bound, pivot = 0.0, -1
            for place, j in enumerate(live):
                bound += lists[j][1]
                if bound >= threshold - 1e-6:
                    pivot = place
                    break
            if pivot < 0:
                break
            item = lists[live[pivot]][0][at[live[pivot]]][0]
            if lists[live[0]][0][at[live[0]]][0] == item:
                score = 0.0
                for j in live:
                    if lists[j][0][at[j]][0] != item:
                        break
                    score += lists[j][0][at[j]][1]
                    at[j] += 1
                if score >= threshold:
                    found.append((item, score))
            else:  # nothing before the pivot can reach the threshold
                for j in live[:pivot]:
                    while at[j] < len(lists[j][0]) and lists[j][0][at[j]][0] < item:
                        at[j] += 1
            live = [j for j in live if at[j] < len(lists[j][0])]
        return found


class _TokenIds(dict):
    """Item term of a raw token: -1 if no item has it, -2 if it is punctuation only."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, token: str) -> int:
        if len(self) >= TOKEN_CACHE:
            self.clear()
        word = normalise(token)
        value = self[token] = self.terms.get(word, -1) if word else -2
        return value


def _bounds_by_tile(index: ItemIndex, tile: np.ndarray, term: np.ndarray, n_tiles: int) -> np.ndarray:
    """Per tile, the sum of the block bounds of its distinct terms."""
    out = np.zeros((n_tiles, index.bounds.shape[1]), np.float32)
    pairs = np.sort(tile * np.int64(len(index.terms)) + term)
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    for i in range(0, len(pairs), BOUND_ROWS):
        tiles, terms = np.divmod(pairs[i : i + BOUND_ROWS], len(index.terms))
        first = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1]])
        out[tiles[first]] += np.add.reduceat(index.bounds[terms], first, axis=0)
    return out


def _runs(words: list[int]) -> set[tuple[int, ...]]:
    return {tuple(words[i : i + n]) for n in range(1, SHINGLE + 1) for i in range(len(words) - n + 1)}


def find_in_texts(index: ItemIndex, ids: _TokenIds, texts: list[str | None], threshold: float,
                  overlap: float) -> list[tuple[int, int, float, float, float]]:
    """``(text number, item number, score, question overlap, answer overlap)`` of
    verified items, each pair once with its best passage."""
    arrays = []
    for t in texts:
        words = (t or "").split()
        a = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        arrays.append(a[a > -2])
    counts = np.array([len(a) for a in arrays], np.int64)
    tiles = -(-counts // index.tile)
    base = np.concatenate([[0], np.cumsum(tiles)])
    if not base[-1]:
        return []
    flat = np.concatenate(arrays)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    tile = np.repeat(base[:-1], counts) + place // index.tile
    known = flat >= 0
    bounds = _bounds_by_tile(index, tile[known], flat[known], int(base[-1]))
    last = np.zeros(int(base[-1]), bool)
    last[base[1:][tiles > 0] - 1] = True
    passage = bounds.copy()  # a passage is a tile and the next one of its text
    passage[:-1] += np.where(last[:-1, None], 0, bounds[1:])
    owner = np.repeat(np.arange(len(texts)), tiles)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    hit_tiles, hit_blocks = np.nonzero(passage >= threshold - 1e-4)
    terms: list[int] = []
    grams: set | None = None
    now = -1
    for p, block in zip(hit_tiles.tolist(), hit_blocks.tolist(), strict=True):
        if p != now:
            now, k = p, int(owner[p])
            start = (p - int(base[k])) * index.tile
            words = arrays[k][start : start + 2 * index.tile]
            terms, grams = np.unique(words[words >= 0]).tolist(), None
        for item, score in index.block_max_wand(terms, block, threshold):
            if span := index.spans[item]:  # where the whole item lies if the part is in the passage
                begin = start - span[0]
                around = _runs(arrays[k][max(0, begin - index.tile) : begin + span[1] + 2 * index.tile].tolist())
            else:
                around = grams = _runs(words.tolist()) if grams is None else grams
            q, a = (len(around & x) / len(x) for x in index.checks[item])
            if q >= overlap and a >= overlap:
                key = (int(owner[p]), item)
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, q, a))
    return [(k, item, *v) for (k, item), v in best.items()]


def _search(batches: Iterator[pa.RecordBatch], index, threshold: float, overlap: float) -> Iterator[pa.RecordBatch]:
    index = index.value
    ids = _TokenIds(index.terms)
    for batch in batches:
        texts, size = batch.column(1), len(batch)
        for start in range(0, size, 1000):
            found = find_in_texts(index, ids, texts.slice(start, 1000).to_pylist(), threshold, overlap)
            docs = batch.column(0).take(pa.array([start + f[0] for f in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([
                docs, pa.array([index.item_ids[f[1]] for f in found], pa.int64()),
                *(pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4)),
            ], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])


def _part_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each part of each item: its group, its length and its distinct words."""
    for batch in batches:
        rows = []
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if words := words_of(text):
                edges = part_edges(len(words))
                rows += [(group, stop - start, sorted(set(words[start:stop])))
                         for start, stop in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.list_(pa.string()))], ["grp", "size", "words"])


def _indexes(benchmark: DataFrame) -> Iterator[Broadcast]:
    """Indexes of all distinct items, in groups of about ``GROUP_CHARS`` characters, with the statistics of all."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    items = materialize(items.where("item_id is not null and text <> ''").distinct(), "benchmark-items")
    groups = int(items.agg(F.sum(F.length("text"))).first()[0] or 0) // GROUP_CHARS + 1
    items = items.withColumn("grp", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    parts = materialize(arrow_map(items.select("grp", "text"), _part_words, "grp long, size long, words array<string>"),
                        "benchmark-parts")
    whole = parts.agg(F.count("size").alias("n"), F.avg("size").alias("mean"), F.max("size").alias("longest")).first()
    word = parts.select("grp", F.explode("words").alias("word"))
    held = word.groupBy("word").agg(F.count(F.lit(1)).alias("held"))
    if groups > 1:
        held = materialize(held, "benchmark-words")
    for g in range(groups if whole["n"] else 0):
        rows = items.where(F.col("grp") == g).select("item_id", "text").collect()  # about GROUP_CHARS characters
        if not rows:
            continue
        own = held if groups == 1 else held.join(word.where(F.col("grp") == g).select("word").distinct(), "word")
        statistics = Statistics(whole["n"], whole["mean"], whole["longest"],
                                {r["word"]: r["held"] for r in own.collect()})  # the words of those items
        index = ItemIndex(sorted((r["item_id"], r["text"]) for r in rows), statistics)
        if index.item_ids:
            yield spark.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Pairs of a document and a test item that it holds.

    Equal items (id and text) count once. Document frequencies and lengths are those of all items, however they
    are grouped for the indexes.

    ``benchmark`` has ``item_id, text``. Returns ``doc_id, item_id, score,
    question_overlap, answer_overlap``, a row per pair with its best passage:
    the BM25 score as a share of the item's own, and the shares of the
    question's and the answer's ``SHINGLE``-word runs in the passage, both at
    least ``overlap``. Passages are all pairs of neighbouring tiles as long as
    the longest indexed item, so an item lies whole in one. An item of more than
    ``PART_WORDS`` words has the score of its best part, and its passage
    is widened by where the part stands in the item, so that all of it is
    looked for. Null or empty texts and items match
    nothing; rows without an id are reported with a null id; repeated
    documents are each reported; empty tables give an empty table.
    Other columns are not read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = None
    for index in _indexes(benchmark):
        step = functools.partial(_search, index=index, threshold=threshold, overlap=overlap)
        part = arrow_map(slim, step, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    # a repeated or split item may be found more than once for a document
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _clean_rows(batches: Iterator[pa.RecordBatch], index, place: int) -> Iterator[pa.RecordBatch]:
    index = index.value
    ids = _TokenIds(index.terms)
    for batch in batches:
        keep = np.ones(len(batch), bool)
        for start in range(0, len(batch), 1000):
            texts = batch.column(place).slice(start, 1000).to_pylist()
            for found in find_in_texts(index, ids, texts, THRESHOLD, OVERLAP):
                keep[start + found[0]] = False
        yield batch.filter(pa.array(keep))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) whose own text holds no test item.

    Each row is judged by itself, with or without an id, also where ids repeat."""
    place = docs.columns.index("text")
    for index in _indexes(benchmark):
        docs = arrow_map(docs, functools.partial(_clean_rows, index=index, place=place), docs.schema)
    return docs
