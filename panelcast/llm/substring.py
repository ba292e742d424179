"""Substring deduplication with fixed-block anchors.

Every window of ``WINDOW`` (13) words holds a whole block of ``BLOCK`` (7)
words that starts at a multiple of 7 in its document. Those non-overlapping
blocks are the index; every rolling 7-word run is a probe. A window can only
repeat in another document if each of its 7-word runs occurs in two documents
and one of them is an indexed block: such windows are extended to full 13-word
keys, and each key is matched with the smallest document that starts it. Runs
of matched windows are the maximal exact repeats; their words are removed.

Documents are packed into chunks of about ``CHUNK_BYTES`` of text. A chunk
sends one sorted run of distinct hashes per hash range, so a passage that is
repeated any number of times reaches a reducer once per chunk, and the answer
is one bit per hash. Texts move once per pass, compressed.
"""

from __future__ import annotations

import functools
import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize
from panelcast.session import ship_package

WINDOW = 13
#: any WINDOW words hold a whole aligned block of this many words
BLOCK = (WINDOW + 1) // 2
CHUNK_BYTES = 4 << 20
#: hashes that a hash range should hold over all chunks
RANGE_WORDS = 1 << 20
#: bits kept of an anchor hash; false anchors only cost work
ANCHOR_BITS = 46
NO_ID = np.iinfo(np.int64).max  # rows without an id come after all others
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: distinct words whose hashes a worker remembers at a time
WORD_CACHE = 400_000

CHUNK_SCHEMA = "chunk long, n_words long, ids binary, lengths binary, texts binary, rest binary"
RUN_SCHEMA = "part int, chunk long, n int, run binary"
ANSWER_SCHEMA = "chunk long, kind int, part int, n int, bits binary"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


_hashes = _WordHashes()


# -- chunks ------------------------------------------------------------------


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue()


def _pack_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, text, other columns)`` into chunks; a longer text is a chunk of its own."""
    number = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype("<i8")
        start = 0
        while start < len(batch):
            fits = int(np.searchsorted(np.cumsum(sizes[start:]), CHUNK_BYTES, "right"))
            part = batch.slice(start, max(1, fits))
            texts = part.column(1).to_pylist()
            ids = pc.fill_null(part.column(0), int(NO_ID)).to_numpy()
            yield pa.RecordBatch.from_pydict({
                "chunk": [(TaskContext.get().partitionId() << 32) + number],
                "n_words": [sum(len(t.split()) for t in texts if t)],
                "ids": [ids.astype("<i8").tobytes()],
                "lengths": [np.array([-1 if t is None else len(t) for t in texts], "<i8").tobytes()],
                "texts": [zstandard.compress(b"".join(t for t in texts if t), 3)],
                "rest": [_ipc(part.select(part.schema.names[2:]))],
            })
            number += 1
            start += len(part)


class _Chunk:
    """Words and word hashes of one chunk's documents."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        lengths = np.frombuffer(row["lengths"], "<i8")  # -1: null
        ends = np.cumsum(np.maximum(lengths, 0)).tolist()
        joined = zstandard.decompress(row["texts"])
        self.texts = [None if n < 0 else joined[i:j] for n, i, j in zip(lengths, [0, *ends], ends, strict=False)]
        self.words = [(t or b"").split() for t in self.texts]
        counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        total = int(self.starts[-1])
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(total) - np.repeat(self.starts[:-1], counts)
        self.hash = np.fromiter((h for w in self.words for h in map(_hashes.__getitem__, w)), np.uint64, total)

    def within(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words at each place lies in one document."""
        n = max(0, len(self.doc) - width + 1)
        return self.doc[:n] == self.doc[width - 1 :][:n]

    def rolling(self, width: int, mult: np.uint64) -> np.ndarray:
        """Hash of the run of ``width`` words at each place."""
        n = max(0, len(self.hash) - width + 1)
        out = np.zeros(n, np.uint64)
        for j in range(width):
            out *= mult
            out += self.hash[j : j + n]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        return out


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


# -- anchors: aligned blocks against rolling probes ---------------------------


class _Anchors:
    """Distinct anchor hashes of a chunk, ascending: ``keys``, with whether two
    documents of the chunk hold one, and whether it is an aligned block."""

    def __init__(self, c: _Chunk):
        self.at = np.flatnonzero(c.within(BLOCK))
        key = c.rolling(BLOCK, _MULT[0])[self.at] >> np.uint64(64 - ANCHOR_BITS)
        order = np.argsort(key, kind="stable")
        new = _heads(key[order])
        first = np.flatnonzero(new)
        self.keys = key[order][first]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        if len(first):
            ids = c.ids[c.doc[self.at[order]]]
            self.shared = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
            self.aligned = np.logical_or.reduceat(c.place[self.at[order]] % BLOCK == 0, first)
        else:
            self.shared = self.aligned = np.zeros(0, bool)


def _encode_run(values: np.ndarray) -> bytes:
    """Ascending values as 4-byte steps where they fit."""
    steps = np.diff(values)
    if len(steps) and steps.max() >> np.uint64(32) == 0:
        return b"s" + values[:1].astype("<u8").tobytes() + steps.astype("<u4").tobytes()
    return b"r" + values.astype("<u8").tobytes()


def _decode_run(run: bytes) -> np.ndarray:
    if run[:1] == b"r":
        return np.frombuffer(run, "<u8", offset=1)
    steps = np.frombuffer(run, "<u4", offset=9).astype(np.uint64)
    return np.concatenate([np.frombuffer(run, "<u8", 1, 1), steps]).cumsum(dtype=np.uint64)


def _cuts(keys: np.ndarray, key_bits: int, part_bits: int) -> np.ndarray:
    """Where each hash range begins and ends in ascending keys."""
    limits = np.arange(1, 1 << part_bits, dtype=np.uint64) << np.uint64(key_bits - part_bits)
    return np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])


def _run_rows(number: int, cuts: np.ndarray, encode) -> pa.RecordBatch:
    filled = [p for p in range(len(cuts) - 1) if cuts[p] < cuts[p + 1]]
    return pa.RecordBatch.from_arrays([
        pa.array(filled, pa.int32()), pa.array([number] * len(filled), pa.int64()),
        pa.array([int(cuts[p + 1] - cuts[p]) for p in filled], pa.int32()),
        pa.array([encode(slice(cuts[p], cuts[p + 1])) for p in filled], pa.binary()),
    ], ["part", "chunk", "n", "run"])


def _anchor_runs(batches: Iterator[pa.RecordBatch], part_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            chunk = _Chunk(batch.slice(i, 1).to_pylist()[0])
            a = _Anchors(chunk)
            values = (a.keys << np.uint64(2)) | (a.shared.astype(np.uint64) << np.uint64(1)) | a.aligned
            yield _run_rows(chunk.number, _cuts(a.keys, ANCHOR_BITS, part_bits), lambda s, v=values: _encode_run(v[s]))


def _answers(table: pa.Table, kind: int, bits: list[np.ndarray]) -> pa.Table:
    """One answer row per run: each of ``bits`` packed, one after the other."""
    sizes = table.column("n").to_numpy()
    ends = np.cumsum(sizes)
    packed = [b"".join(np.packbits(b[e - n : e]).tobytes() for b in bits) for n, e in zip(sizes, ends, strict=True)]
    return pa.table({
        "chunk": table.column("chunk"), "kind": pa.array([kind] * len(sizes), pa.int32()),
        "part": table.column("part"), "n": table.column("n"), "bits": pa.array(packed, pa.binary()),
    })


def _match_anchors(table: pa.Table) -> pa.Table:
    """For each anchor of a hash range: do two documents hold it, and is it then also an indexed block."""
    values = np.concatenate([_decode_run(r) for r in table.column("run").to_pylist()])
    key = values >> np.uint64(2)
    order = np.argsort(key, kind="stable")
    new = _heads(key[order])
    first = np.flatnonzero(new)
    flags = np.bitwise_or.reduceat(values[order], first) & np.uint64(3)
    runs = np.diff(np.append(first, len(order)))
    shared = (runs > 1) | (flags & np.uint64(2) != 0)
    group = np.cumsum(new) - 1
    out = np.empty((2, len(order)), bool)
    out[0, order] = shared[group]
    out[1, order] = (shared & (flags & np.uint64(1) != 0))[group]
    return _answers(table, 0, list(out))


# -- windows: extension of anchors to exact repeats ---------------------------


def _unpack(answers: list[dict], kind: int, planes: int) -> list[np.ndarray]:
    rows = sorted((r for r in answers if r["kind"] == kind), key=lambda r: r["part"])
    out: list[list[np.ndarray]] = [[np.zeros(0, bool)] for _ in range(planes)]
    for r in rows:
        width = (r["n"] + 7) // 8
        raw = np.frombuffer(r["bits"], np.uint8)
        for p in range(planes):
            out[p].append(np.unpackbits(raw[p * width : (p + 1) * width], count=r["n"]).astype(bool))
    return [np.concatenate(x) for x in out]


class _Windows:
    """Windows of a chunk that may repeat: places ``at``, distinct keys ``(h1, h2)``
    ascending with the smallest id of the chunk that starts each, and the key of each window."""

    def __init__(self, c: _Chunk, answers: list[dict]):
        anchors = _Anchors(c)
        shared, indexed = _unpack(answers, 0, 2)
        inside = c.within(WINDOW)
        span = WINDOW - BLOCK + 1

        def count(flags: np.ndarray) -> np.ndarray:
            marks = np.zeros(len(c.hash) + 1, np.int64)
            marks[anchors.at + 1] = flags[anchors.group]
            sums = np.cumsum(marks)
            return sums[span : span + len(inside)] - sums[: len(inside)]

        self.at = np.flatnonzero(inside & (count(shared) == span) & (count(indexed) > 0))
        h1 = c.rolling(WINDOW, _MULT[0])[self.at]
        h2 = c.rolling(WINDOW, _MULT[1])[self.at] >> np.uint64(32)
        order = np.lexsort((h2, h1))
        new = _heads(h1[order], h2[order])
        first = np.flatnonzero(new)
        self.h1, self.h2 = h1[order][first], h2[order][first].astype("<u4")
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        ids = c.ids[c.doc[self.at[order]]]
        self.least = np.minimum.reduceat(ids, first) if len(first) else ids


def _window_runs(left: pa.Table, right: pa.Table, part_bits: int) -> pa.Table:
    rows = []
    for row in left.to_pylist():
        chunk = _Chunk(row)
        w = _Windows(chunk, right.to_pylist())

        def encode(s: slice, w=w) -> bytes:
            return w.h1[s].astype("<u8").tobytes() + w.h2[s].tobytes() + w.least[s].astype("<i8").tobytes()

        rows.append(_run_rows(chunk.number, _cuts(w.h1, 64, part_bits), encode))
    return pa.Table.from_batches(rows, _run_rows(0, np.zeros(2, int), None).schema)


def _match_windows(table: pa.Table) -> pa.Table:
    """For each window of a hash range: does a smaller document than its chunk's smallest start it."""
    h1, h2, least = [], [], []
    for n, run in zip(table.column("n").to_pylist(), table.column("run").to_pylist(), strict=True):
        h1.append(np.frombuffer(run, "<u8", n))
        h2.append(np.frombuffer(run, "<u4", n, 8 * n))
        least.append(np.frombuffer(run, "<i8", n, 12 * n))
    h1, h2, least = np.concatenate(h1), np.concatenate(h2), np.concatenate(least)
    order = np.lexsort((h2, h1))
    new = _heads(h1[order], h2[order])
    overall = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    smaller = np.empty(len(order), bool)
    smaller[order] = overall < least[order]
    return _answers(table, 1, [smaller])


def _remove(left: pa.Table, right: pa.Table, names: list[str]) -> pa.Table:
    out = []
    for row in left.to_pylist():
        c = _Chunk(row)
        w = _Windows(c, right.to_pylist())
        (smaller,) = _unpack(right.to_pylist(), 1, 1)
        gone = w.at[smaller[w.group] | (c.ids[c.doc[w.at]] > w.least[w.group])]
        steps = np.zeros(len(c.hash) + 1, np.int64)
        np.add.at(steps, gone, 1)
        np.add.at(steps, gone + WINDOW, -1)
        covered = np.cumsum(steps)[:-1] > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(covered)])[c.starts])
        texts, digests = [], []
        for i, words in enumerate(c.words):
            if removed[i]:
                words = [words[k] for k in np.flatnonzero(~covered[c.starts[i] : c.starts[i + 1]]).tolist()]
            kept = b" ".join(words)
            texts.append(kept if removed[i] else c.texts[i])
            digests.append(hashlib.sha256(kept).hexdigest())
        rest = pa.ipc.open_stream(row["rest"]).read_all().combine_chunks()
        id_of = pa.array(c.ids, mask=c.ids == NO_ID)
        out.append(pa.table([
            id_of, pa.array(np.diff(c.starts)), pa.array(removed.astype(np.int64)), pa.array(digests, pa.string()),
            pa.array(texts, pa.binary()).cast(pa.string()), *rest.columns], names))
    return pa.concat_tables(out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word that lies in a ``WINDOW``-word run which a document with a smaller id also holds.

    Words are runs of bytes other than ASCII white space, compared unchanged,
    over whole texts as they came in. Returns the columns of ``docs`` in their
    order, the text of documents that lost words being the kept words joined
    by one space, then ``n_words``, ``n_removed`` (long) and ``kept_sha256``
    (SHA-256 of the kept words joined by one space); input columns of these
    three names are replaced. A null or empty text has no words and stays;
    rows without an id count as larger than all others and do not remove from
    each other, nor do rows with equal ids; repeated rows stay; an empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    own = ["n_words", "n_removed", "kept_sha256"]
    others = [c for c in docs.columns if c not in (id_col, text_col, *own)]
    packed = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                         F.col(f"`{text_col}`").cast("binary").alias("_text"),
                         *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)))
    chunks = materialize(arrow_map(packed, _pack_documents, CHUNK_SCHEMA), "substring-chunks")
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    part_bits = max(0, (words // RANGE_WORDS).bit_length())

    runs = arrow_map(chunks, functools.partial(_anchor_runs, part_bits=part_bits), RUN_SCHEMA)
    anchors = materialize(runs.groupBy("part").applyInArrow(_match_anchors, ANSWER_SCHEMA), "substring-anchors")
    by_chunk = chunks.groupBy("chunk")
    runs = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(
        functools.partial(_window_runs, part_bits=part_bits), RUN_SCHEMA)
    windows = materialize(runs.groupBy("part").applyInArrow(_match_windows, ANSWER_SCHEMA), "substring-windows")

    fields = {f.name: f.dataType.simpleString() for f in packed.schema.fields[2:]}
    fields = {"_id": "long", **{f"_{c}": "long" for c in own[:2]}, "_kept_sha256": "string", "_text": "string", **fields}
    done = by_chunk.cogroup(anchors.unionByName(windows).groupBy("chunk")).applyInArrow(
        functools.partial(_remove, names=list(fields)), ", ".join(f"{k} {v}" for k, v in fields.items()))
    back = {id_col: "_id", text_col: "_text"} | {c: f"_{i}" for i, c in enumerate(others)}
    return done.select(*(F.col(back[c]).alias(c) for c in docs.columns if c in back),
                       *(F.col(f"_{c}").alias(c) for c in own))
