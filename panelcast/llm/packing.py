"""Order-preserving packing of documents into training sequences.

Documents in id order make one stream of ids, each closed by an end id. The
stream is cut into sequences of at most ``CAPACITY`` ids by dynamic
programming: a cut at a document's end is free, at a sentence's end it costs
little, inside a sentence more, and a sequence costs its padding. The best
cut before each place is the least of ``cost + place`` in a sliding window, kept in a
monotone queue, so a cut takes constant time. A sequence whose length is a
power of two needs no padding; such short ones are weighed in the same
recurrence for a small charge.

Ranges of ids are packed by separate tasks, each in segments of bounded size:
only the cuts well before a segment's end are kept, the rest joins the next.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, vocabulary_text
from panelcast.llm.tokens import encoder_for

CAPACITY = 1024
#: ids of padding that a cut is worth
SENTENCE_COST, INSIDE_COST = 2.0, 24.0
#: cuts inside sentences longer than LONG_SENTENCE are offered every INSIDE_STEP ids
LONG_SENTENCE, INSIDE_STEP = 64, 16
#: unpadded sequences shorter than the capacity, and what each is charged
SHORT_SIZES, SHORT_COST = (128, 256, 512), 8.0
#: ids packed at a time, and how many of them before the end are left for the next time
SEGMENT, MARGIN = 1 << 20, 8 * CAPACITY


def offered_cuts(ids: np.ndarray, sentence_end: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (0 and the length included) and costs of cuts; no gap exceeds ``LONG_SENTENCE``.

    ``sentence_end`` flags the ids that close a sentence.
    """
    cost = np.full(len(ids) + 1, INSIDE_COST)
    cost[1:][sentence_end[ids]] = SENTENCE_COST
    cost[1:][ids == end_id] = 0.0
    cost[[0, -1]] = 0.0
    good = np.flatnonzero(cost < INSIDE_COST)
    gaps = np.diff(good)
    wide = np.flatnonzero(gaps > LONG_SENTENCE)
    inner = [np.arange(good[i] + INSIDE_STEP, good[i + 1], INSIDE_STEP) for i in wide]
    places = np.sort(np.concatenate([good, *inner])) if inner else good
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """The cuts, first and last place included, of least padding plus cutting cost.

    Gaps between places must not exceed ``capacity``.
    """
    n = len(places)
    shorts: dict[int, list[tuple[int, float]]] = {}
    for size in SHORT_SIZES:
        if size < capacity:
            at = np.searchsorted(places, places - size)
            for j in np.flatnonzero((places >= size) & (places[np.minimum(at, n - 1)] == places - size)).tolist():
                shorts.setdefault(j, []).append((int(at[j]), size + SHORT_COST))
    place, cost = places.tolist(), costs.tolist()
    keys, before = [0.0] * n, [0] * n  # a key is the least cost up to a place, plus the place
    # places of ascending keys from ``queue[head]`` on; a new key exceeds the head's, so that one stays
    queue, head = [0], 0
    for j in range(1, n):
        least = place[j] - capacity
        while place[queue[head]] < least:
            head += 1
        source = queue[head]
        key = keys[source] + capacity
        if j in shorts:
            for i, charge in shorts[j]:
                if keys[i] + charge < key:
                    key, source = keys[i] + charge, i
        keys[j] = key = key + cost[j]
        before[j] = source
        while keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [place[-1]], n - 1
    while j:
        j = before[j]
        cuts.append(place[j])
    return cuts[::-1]


class _Packer:
    """Cuts one task's stream; what is not yet cut is carried over."""

    def __init__(self, sentence_end: np.ndarray, end_id: int, capacity: int, first_sequence: int):
        self.sentence_end, self.end_id, self.capacity = sentence_end, end_id, capacity
        self.sequence = first_sequence
        self.origin = 0  # place in the stream of the first id that is held
        self.held: list[np.ndarray] = []
        self.size = 0
        self.docs: list[tuple[int | None, int, int]] = []  # id, place, ids

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = np.append(ids, np.uint32(self.end_id)).astype("<u4")
        self.docs.append((doc_id, self.origin + self.size, len(whole)))
        self.held.append(whole)
        self.size += len(whole)
        if self.size >= SEGMENT:
            yield from self.cut(last=False)

    def cut(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        ids = np.concatenate(self.held)
        cuts = np.array(best_cuts(*offered_cuts(ids, self.sentence_end, self.end_id), self.capacity))
        if not last:
            cuts = cuts[: max(1, np.searchsorted(cuts, len(ids) - MARGIN, "right"))]
        yield from self._pieces(ids, cuts)
        done = int(cuts[-1])
        self.sequence += len(cuts) - 1
        self.held, self.size = [ids[done:]], len(ids) - done
        self.origin += done
        self.docs = [d for d in self.docs if d[1] + d[2] > self.origin]

    def _pieces(self, ids: np.ndarray, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        begins = np.array([d[1] for d in self.docs]) - self.origin
        edges = np.unique(np.concatenate([cuts, begins[(begins > 0) & (begins < cuts[-1])]]))
        start, stop = edges[:-1], edges[1:]
        doc = np.searchsorted(begins, start, "right") - 1
        sequence = np.searchsorted(cuts, start, "right") - 1
        raw = ids.tobytes()
        of = [self.docs[d] for d in doc.tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in of], pa.int64()), pa.array(start - begins[doc]), pa.array(stop - start),
            pa.array([d[2] for d in of], pa.int64()), pa.array(sequence + self.sequence),
            pa.array(start - cuts[sequence]),
            pa.array([raw[4 * i : 4 * j] for i, j in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()),
        ], PIECES)


PIECES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _pack_partition(batches: Iterator[pa.RecordBatch], vocabulary, end_id: int,
                    capacity: int) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(vocabulary.value)
    vocab = encoder.tokenizer.get_vocab(with_added_tokens=True)
    sentence_end = np.zeros(max(max(vocab.values()), end_id) + 1, bool)
    for token, i in vocab.items():
        # Ċ is a line feed in byte-level vocabularies
        sentence_end[i] = token.replace("</w>", "").endswith((".", "!", "?", "Ċ"))
    packer = _Packer(sentence_end, end_id, capacity, TaskContext.get().partitionId() << 40)
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for at in range(0, len(batch), 500):
            texts = batch.column(1).slice(at, 500).to_pylist()
            for doc_id, ids in zip(doc_ids[at : at + 500], encoder.encode(texts), strict=True):
                yield from packer.add(doc_id, ids)
    yield from packer.cut(last=True)


def pack(docs: DataFrame, vocabulary_path: str, end_id: int = 0, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole documents, in id order, into sequences of at most ``capacity`` ids.

    Returns a row per piece: ``doc_id``, ``start`` (its document's ids
    before it), ``length``, ``doc_tokens`` (with the end id), ``sequence_id``,
    ``offset`` (in the sequence, without gaps from 0) and ``ids`` (binary,
    little-endian unsigned 32-bit). Every id lies in exactly one piece. A null
    or empty text is its end id alone; rows without an id come first; rows
    with equal ids are documents of their own in the order of their text's
    hash; an empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text"))
    ranged = slim.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    step = functools.partial(_pack_partition, vocabulary=vocabulary, end_id=end_id, capacity=capacity)
    return arrow_map(ranged, step, PIECE_SCHEMA)
