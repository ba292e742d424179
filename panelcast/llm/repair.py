"""Token ids in files, compressed by Re-Pair grammars.

A shard is a run of documents in id order. Re-Pair replaces frequent pairs of
neighbouring symbols by new symbols, over and over: each round counts all
pairs of the shard and replaces the most frequent ones that cannot overlap.
The file holds the rules, how many ids each rule's symbol expands to, the
final symbols, and where each document begins in them, so that any document,
or any range of its ids, is decoded without the rest. Pairs never hold the end
id, so documents begin at symbol borders.

File format (little-endian): magic ``RPID``, u16 version, u16 width of a
symbol, u32 first rule symbol, u64 counts of rules, symbols and documents;
then rules (two symbols each), expansion lengths (u32 per rule), symbols,
document ids (i64), a byte per document that is 1 where the id is null,
symbols per document (u64), ids per document (u64).
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize, vocabulary_text
from panelcast.llm.files import make_folder, write_whole
from panelcast.llm.tokens import encoder_for
from panelcast.session import scratch_path

MAGIC, VERSION = b"RPID", 1
HEADER = struct.Struct("<4sHHIQQQ")
#: ids of a shard (a longer document makes a longer shard)
SHARD_IDS = 1 << 21
#: pairs replaced in a round, and how often one must occur
ROUND_PAIRS, LEAST_COUNT = 2048, 16


def _codes(left: np.ndarray, right: np.ndarray, barrier: int) -> np.ndarray:
    """Codes ``left << 32 | right`` of pairs, without those that hold ``barrier``."""
    plain = (left != barrier) & (right != barrier)
    return (left[plain].astype(np.int64) << 32) | right[plain]


def _counted(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes that occur ``least`` times, ascending, and how often."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(codes)))
    often = counts >= least
    return codes[first[often]], counts[often]


def _all_counts(seq: np.ndarray, barrier: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a whole sequence; 16-bit symbols are sorted as 32-bit codes."""
    if not len(seq) or int(seq.max()) >> 16:
        return _counted(_codes(seq[:-1], seq[1:], barrier), least)
    left, right = seq[:-1].astype(np.uint32), seq[1:].astype(np.uint32)
    codes, counts = _counted(((left << np.uint32(16)) | right)[(left != barrier) & (right != barrier)], least)
    codes = codes.astype(np.int64)
    return ((codes >> 16) << 32) | (codes & 0xFFFF), counts


def chosen_pairs(codes: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """The most frequent of the pairs, ascending; no symbol is a left in one and a right in
    another, so that only a symbol doubled can overlap itself."""
    lefts, rights, doubled, chosen = set(), set(), set(), []
    for code in codes[np.lexsort((codes, -counts))].tolist():
        if len(chosen) == limit:
            break
        a, b = code >> 32, code & 0xFFFFFFFF
        if a == b:
            if a in lefts or a in rights or a in doubled:
                continue
            doubled.add(a)
        elif a in rights or b in lefts or a in doubled or b in doubled:
            continue
        else:
            lefts.add(a)
            rights.add(b)
        chosen.append(code)
    return np.sort(np.array(chosen, np.int64))


def replaced_places(seq: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a pair is replaced, from the left, and which pair."""
    lefts, rights = np.unique(pairs >> 32), np.unique(pairs & 0xFFFFFFFF)
    top = int(max(seq.max(), lefts[-1], rights[-1])) + 1
    row, column = np.full(top, -1, np.int32), np.full(top, -1, np.int32)
    row[lefts], column[rights] = np.arange(len(lefts)) * len(rights), np.arange(len(rights))
    table = np.full(len(lefts) * len(rights), -1, np.int32)  # at most a round's pairs squared
    table[row[pairs >> 32] + column[pairs & 0xFFFFFFFF]] = np.arange(len(pairs))
    begins = row[seq[:-1]]
    at = np.flatnonzero(begins >= 0)
    ends = column[seq[at + 1]]
    at, ends = at[ends >= 0], ends[ends >= 0]
    rule = table[begins[at] + ends]
    at, rule = at[rule >= 0], rule[rule >= 0]
    if len(at):  # of overlapping places (a symbol doubled) every second one from the left
        run = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1
        begin = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        even = (np.arange(len(at)) - begin[run]) % 2 == 0
        at, rule = at[even], rule[even]
    return at, rule


def _replaced(seq: np.ndarray, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """``seq`` with ``symbols`` for the pairs at the places ``at``."""
    out = seq.copy()
    out[at] = symbols
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    return out[keep]


def replace_pairs(seq: np.ndarray, pairs: np.ndarray, first_symbol: int) -> np.ndarray:
    """``seq`` with pair ``i`` of ``pairs`` replaced by symbol ``first_symbol + i``, from the left."""
    at, rule = replaced_places(seq, pairs)
    return _replaced(seq, at, first_symbol + rule)


def _near(at: np.ndarray, length: int, offsets: tuple[int, ...]) -> np.ndarray:
    """Places of pairs around ``at`` in a sequence, each once."""
    near = np.zeros(max(0, length - 1), bool)
    for k in offsets:
        place = at + k
        near[place[(place >= 0) & (place < len(near))]] = True
    return np.flatnonzero(near)


@dataclass
class Grammar:
    """Rules ``first + i -> rules[i]``, ids that each rule expands to, and the final symbols."""

    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def symbol_lengths(self, symbols: np.ndarray) -> np.ndarray:
        if not len(self.rules):
            return np.ones(len(symbols), np.int64)
        rule = symbols.astype(np.int64) - self.first
        return np.where(rule >= 0, self.lengths[np.maximum(rule, 0)], 1)

    def _undone(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols; each pass undoes one level of rules."""
        symbols = symbols.astype(np.int64)
        while len(self.rules) and (is_rule := symbols >= self.first).any():
            width = np.where(is_rule, 2, 1)
            at = np.cumsum(width) - width
            out = np.empty(int(width.sum()), np.int64)
            out[at[~is_rule]] = symbols[~is_rule]
            pair = self.rules[symbols[is_rule] - self.first]
            out[at[is_rule]], out[at[is_rule] + 1] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols.astype("<u4")

    @functools.cached_property
    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rules one after the other, and where each rule's begin."""
        return self._undone(np.arange(self.first, self.first + len(self.rules))), np.cumsum(self.lengths) - self.lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols: those of each rule are copied from its expansion."""
        if not len(self.rules) or not len(symbols):
            return symbols.astype("<u4")
        flat, begins = self._expansions
        rule = symbols.astype(np.int32) - np.int32(self.first)
        is_rule = rule >= 0
        size = np.ones(len(symbols), np.int32)
        size[is_rule] = self.lengths[rule[is_rule]]
        at = np.cumsum(size, dtype=np.int64) - size
        # places in the expansions, counted on from where each rule's symbol stands
        shift = np.zeros(len(symbols), np.int64)
        shift[is_rule] = begins[rule[is_rule]] - at[is_rule]
        out = np.empty(int(at[-1] + size[-1]), "<u4")
        out[at[~is_rule]] = symbols[~is_rule]
        from_rule = np.repeat(is_rule, size)
        where = np.flatnonzero(from_rule)
        out[where] = flat[where + np.repeat(shift[is_rule], size[is_rule])]
        return out


def compress(ids: np.ndarray, barrier: int, first: int, round_pairs: int = ROUND_PAIRS,
             least: int = LEAST_COUNT) -> Grammar:
    """Grammar of ``ids``; no rule holds ``barrier``. ``first`` exceeds all ids.

    Rounds go on until no pair occurs ``least`` times or the symbols' width is full. Pairs
    are counted once; after a round only those at replaced places change: old ones lose
    counts, new ones hold a new symbol and are counted for themselves. A pair that
    is too rare stays so."""
    seq = ids.astype(np.uint32)
    rules, lengths = [], np.zeros(0, np.int64)
    room = max(0, (1 << 16) - first)  # symbols stay in 16 bits where the ids do
    codes, counts = _all_counts(seq, barrier, least)
    while True:
        count = sum(map(len, rules))
        limit = min(round_pairs, room - count) if room else round_pairs
        pairs = chosen_pairs(codes, counts, limit) if limit > 0 else []
        if not len(pairs):
            break
        at, rule = replaced_places(seq, pairs)
        old = _near(at, len(seq), (-1, 0, 1))
        gone = np.sort(_codes(seq[old], seq[old + 1], barrier))
        counts = counts - (np.searchsorted(gone, codes, "right") - np.searchsorted(gone, codes, "left"))
        seq = _replaced(seq, at, first + count + rule)
        new = _near(at - np.arange(len(at)), len(seq), (-1, 0))
        more, often = _counted(_codes(seq[new], seq[new + 1], barrier), least)
        stay = counts >= least
        codes, counts = np.concatenate([codes[stay], more]), np.concatenate([counts[stay], often])
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        both = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)
        known = np.concatenate([np.ones(first, np.int64), lengths])
        lengths = np.concatenate([lengths, known[both].sum(1)])
        rules.append(both)
    return Grammar(first, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), lengths, seq)


def shard_file(doc_ids: list[int | None], documents: list[np.ndarray], end_id: int, first: int) -> list[bytes]:
    """The parts of one shard's file; each document's array ends with ``end_id``, which it may also hold inside."""
    sizes = np.array([len(d) for d in documents], "<u8")
    marked = np.concatenate(documents).astype(np.int64)
    ends = np.cumsum(sizes).astype(np.int64) - 1
    # the closing end ids get a symbol of their own, as a text may hold the end id too
    closing = first
    marked[ends] = closing
    grammar = compress(marked, closing, first + 1)
    kind = "<u2" if first + 1 + len(grammar.rules) <= 1 << 16 else "<u4"
    per_doc = np.diff(np.concatenate([[-1], np.flatnonzero(grammar.symbols == closing)])).astype("<u8")
    head = HEADER.pack(MAGIC, VERSION, int(kind[-1]), first + 1, len(grammar.rules), len(grammar.symbols), len(sizes))
    return [head, grammar.rules.astype(kind).tobytes(), grammar.lengths.astype("<u4").tobytes(),
            grammar.symbols.astype(kind).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(), per_doc.tobytes(), sizes.tobytes()]


class Shard:
    """A shard's file, opened for random access."""

    def __init__(self, content: bytes, end_id: int):
        magic, version, width, first, n_rules, n_symbols, n_docs = HEADER.unpack_from(content)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        rules = take(f"<u{width}", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.grammar = Grammar(first, rules, take("<u4", n_rules).astype(np.int64), take(f"<u{width}", n_symbols))
        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), null.tolist(), strict=True)]
        per_doc, self.sizes = take("<u8", n_docs).astype(np.int64), take("<u8", n_docs).astype(np.int64)
        self.ends = np.cumsum(per_doc)
        self.end_id = end_id

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``k`` (its end id included); only
        the symbols that cover them are expanded."""
        symbols = self.grammar.symbols[self.ends[k - 1] if k else 0 : self.ends[k]]
        stop = int(self.sizes[k]) if stop is None else min(stop, int(self.sizes[k]))
        if start >= stop:
            return np.zeros(0, "<u4")
        after = np.cumsum(self.grammar.symbol_lengths(symbols))
        i, j = np.searchsorted(after, start, "right"), np.searchsorted(after, stop, "left")
        skipped = int(after[i - 1]) if i else 0
        return self._plain(self.grammar.expand(symbols[i : j + 1]))[start - skipped : stop - skipped]

    def _plain(self, ids: np.ndarray) -> np.ndarray:
        ids[ids == self.grammar.first - 1] = self.end_id
        return ids

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of all documents, in order."""
        ids = self._plain(self.grammar.expand(self.grammar.symbols))
        yield from np.split(ids, np.cumsum(self.sizes)[:-1])


def _write_partition(batches: Iterator[pa.RecordBatch], vocabulary, end_id: int, folder: str) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(vocabulary.value)
    first = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
    part, number = TaskContext.get().partitionId(), 0
    doc_ids: list[int | None] = []
    documents: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal number, held
        name = f"shard-{part:08d}-{number:08d}.rpid"
        size = write_whole(folder, name, shard_file(doc_ids, documents, end_id, first))
        row = {"part": [part], "number": [number], "name": [name], "n_docs": [len(doc_ids)], "n_ids": [held],
               "n_bytes": [size]}
        number, held = number + 1, 0
        doc_ids.clear()
        documents.clear()
        return pa.RecordBatch.from_pydict(row, MANIFEST)

    for batch in batches:
        ids_of = batch.column(0).to_pylist()
        for at in range(0, len(batch), 500):
            encoded = encoder.encode(batch.column(1).slice(at, 500).to_pylist())
            for doc_id, ids in zip(ids_of[at : at + 500], encoded, strict=True):
                doc_ids.append(doc_id)
                documents.append(np.append(ids, np.uint32(end_id)))
                held += len(ids) + 1
                if held >= SHARD_IDS:
                    yield flush()
    if doc_ids:
        yield flush()


MANIFEST = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()),
                      ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
MANIFEST_SCHEMA = "part int, number int, name string, n_docs long, n_ids long, n_bytes long"


def write_ids(docs: DataFrame, vocabulary_path: str, end_id: int, folder: str | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Encode whole texts and write them as shard files in ascending id order.

    Returns the folder (a new one in the shared checkpoint folder if none is
    given) and the manifest: a row per file, ``part, number, name, n_docs,
    n_ids, n_bytes``; files sort by ``part, number``. Only files of the
    manifest count. A null or empty text is its end id alone; rows without an
    id come first; rows with equal ids are documents of their own in the order
    of their text's hash; an empty table writes no file.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, f"token-shards-{uuid.uuid4().hex}")
    make_folder(folder)
    vocabulary = spark.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text"))
    ranged = slim.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    step = functools.partial(_write_partition, vocabulary=vocabulary, end_id=end_id, folder=folder)
    return folder, materialize(arrow_map(ranged, step, MANIFEST_SCHEMA), "token-shards-manifest")


def _read_shards(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(content, end_id)
            starts = before + np.cumsum(shard.sizes) - shard.sizes
            raw = [d.tobytes() for d in shard.documents()]
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.doc_ids, pa.int64()), pa.array(starts), pa.array(shard.sizes), pa.array(raw, pa.binary()),
            ], ["doc_id", "start", "n_tokens", "ids"])


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame, end_id: int) -> DataFrame:
    """Decode all files of a manifest: ``doc_id, start, n_tokens, ids`` per
    document, ``start`` counting the ids of all documents before it and
    ``ids`` as little-endian unsigned 32-bit."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per task
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("part", "name", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside"))
    starts = starts.join(parts, "part").select("name", (F.col("before_part") + F.col("inside")).alias("before"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rpid").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return arrow_map(files.join(starts, "name").select("before", "content"),
                     functools.partial(_read_shards, end_id=end_id),
                     "doc_id long, start long, n_tokens long, ids binary")
