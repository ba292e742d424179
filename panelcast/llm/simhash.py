"""SimHash near-duplicates by the generalised pigeonhole principle.

Each text gets a 64-bit fingerprint of its word shingles. Two fingerprints
within ``k`` bits agree up to ``T_i`` bits in some partition ``i`` of the 64
bits whenever ``sum(T_i) = k - m + 1`` over ``m`` partitions. Correlated bits
share a partition, and the thresholds ``T_i`` (-1 skips a partition) are
allotted by dynamic programming on the candidates and probes that each would
cost. Fingerprints are indexed by their bits in a partition, probed with all
variants up to ``T_i`` flipped bits, and verified on all 64 bits within the
join, so that only true links leave it.

Exact repeats of a fingerprint are one class before anything is joined, so
groups of copies of any size count once. A class has at most
``sum(C(64, d), d <= k)`` links, however many documents it stands for.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize
from panelcast.llm.components import connected_components

BITS = 64
SEED = 42
#: shingles whose bits are counted at a time; bounds memory on very long texts
COUNT_BLOCK = 1 << 16
#: cost of comparing two fingerprints in the join, against 1 for a shuffled probe
COMPARE_COST = 0.1


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one UTF-8 text: a bit is set if it is set in
    over half of the shingles' XXH64 (repeats included). Words are runs of
    bytes other than ASCII white space, A-Z in lower case; fewer words than a
    shingle make one shingle, no words (or null) give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), COUNT_BLOCK):
        block = zip(starts[at : at + COUNT_BLOCK], ends[at : at + COUNT_BLOCK], strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in block], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, len(batch))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return arrow_map(slim, functools.partial(_fingerprint_batches, shingle=shingle), "id long, fp long")


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        raw = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
        total += np.rint(bits.T @ bits).astype(np.int64)  # a batch is far below 2**24 rows
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS)), pa.array(total.ravel())], ["cell", "n"])


def bit_statistics(classes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of each set bit, and correlation of the bits.

    Over all fingerprints; one 64 x 64 table of sums reaches the driver.
    """
    n = classes.count()
    sums = arrow_map(classes.select("fp"), _bit_sums, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    joint = np.zeros(BITS * BITS)
    for row in sums.collect():  # 4096 rows
        joint[row["cell"]] = row["n"]
    joint = joint.reshape(BITS, BITS) / max(1, n)
    share = np.diag(joint).copy()
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return n, share, (joint - np.outer(share, share)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` even partitions; each grows by the bit that correlates most with it."""
    strength = np.abs(correlation)
    free = set(range(BITS))
    parts = []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        part = [max(sorted(free), key=lambda b: strength[b, sorted(free)].sum())]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(sorted(free), key=lambda b: strength[b, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def agreement(share: np.ndarray) -> np.ndarray:
    """Chance of two fingerprints differing in 0, 1, ... of these bits."""
    dist = np.ones(1)
    for differ in 2 * share * (1 - share):
        dist = np.convolve(dist, [1 - differ, differ])
    return dist


def allot_thresholds(parts: list[list[int]], share: np.ndarray, n: int, k: int) -> tuple[float, list[int]]:
    """Thresholds ``T_i >= -1`` with sum ``k - m + 1`` of the least cost per
    fingerprint, by dynamic programming over the partitions.

    Cost: one per probe, ``COMPARE_COST`` per candidate estimated from the
    share of set bits.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        chance = np.cumsum(agreement(share[part]))
        grown: dict[int, tuple[float, list[int]]] = {}
        for (used, (cost, chosen)), t in itertools.product(best.items(), range(-1, k + 1)):
            own = 0.0
            if t >= 0:
                t_in = min(t, len(part))
                own = sum(math.comb(len(part), d) for d in range(t_in + 1)) + COMPARE_COST * n * chance[t_in]
            if used + t not in grown or cost + own < grown[used + t][0]:
                grown[used + t] = (cost + own, [*chosen, t])
        best = grown
    return best[k - len(parts) + 1]


def plan_partitions(n: int, share: np.ndarray, correlation: np.ndarray, k: int) -> list[tuple[list[int], int]]:
    """The cheapest partitions and thresholds, over all numbers of partitions up to ``k + 1``."""
    plans = []
    for m in range(1, k + 2):
        parts = group_bits(correlation, m)
        cost, thresholds = allot_thresholds(parts, share, n, k)
        plans.append((cost, m, list(zip(parts, thresholds, strict=True))))
    return [(bits, t) for bits, t in min(plans)[2] if t >= 0]


def _signed(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links_within(classes: DataFrame, k: int = 3) -> DataFrame:
    """All pairs ``(a, b)`` of distinct fingerprints (column ``fp``, no repeats)
    that differ in at most ``k`` bits; a pair may repeat."""
    plan = plan_partitions(*bit_statistics(classes), k)
    fp = F.col("fp")

    def entries(i: int, bits: list[int], t: int, flips: bool) -> Column:
        """Index (or probe) entries of partition ``i``: its bits, unchanged (or with up to ``t`` flips)."""
        key = fp.bitwiseAND(F.lit(_signed(bits)))
        flipped = itertools.chain.from_iterable(itertools.combinations(bits, d) for d in range(t + 1 if flips else 1))
        masks = F.array(*(F.lit(_signed(list(c))).cast("long") for c in flipped))
        return F.transform(masks, lambda mask: F.struct(F.lit(i).alias("part"), key.bitwiseXOR(mask).alias("key")))

    def keyed(flips: bool) -> DataFrame:
        every = F.concat(*(entries(i, bits, t, flips) for i, (bits, t) in enumerate(plan)))
        return classes.select("fp", F.explode(every).alias("e")).select("fp", "e.part", "e.key")

    index, probe = keyed(False).withColumnRenamed("fp", "b"), keyed(True).withColumnRenamed("fp", "a")
    near = (index.part == probe.part) & (index.key == probe.key) & (F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= k)
    return probe.join(index, near).select("a", "b")


def _components(fps: DataFrame, least: Column, k: int) -> DataFrame:
    """``fp`` and ``least``: each fingerprint with the smallest ``least`` of its near-duplicate group."""
    classes = materialize(fps.groupBy("fp").agg(F.min(least).alias("least")), "simhash-classes")
    roots = connected_components(links_within(classes, k)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.drop("least").join(groups, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, k: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate group of every row of ``docs``.

    Returns ``doc_id, fingerprint, component_id``: the fingerprint as 16
    lowercase hex digits, and the smallest id that is reached over links of
    at most ``k`` bits, itself included. Only the id and text columns are
    read, so other columns may have any name. Null and empty texts have
    fingerprint 0 and link like any other; rows without an id keep a null id
    and take the smallest id of their group (null if it has none); repeated
    rows stay; an empty table gives an empty table.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    labels = _components(fps, F.col("id"), k).withColumnRenamed("least", "component_id")
    return fps.join(labels, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, k: int = 3) -> DataFrame:
    """One row of ``docs`` (columns unchanged) of each group of near duplicates.

    The row with the smallest ``doc_id`` stays; rows without an id come after all others, and of
    rows with equal ids one stays. Rows are numbered and stored once, so each is judged by itself.
    """
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    fps = materialize(fingerprints(numbered, "_row", "text", shingle), "simhash-fingerprints")
    by_id = fps.withColumnRenamed("id", "_row").join(numbered.select("_row", F.col("doc_id").cast("long").alias("doc")), "_row")
    by_id = materialize(by_id, "simhash-numbered")
    least = F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("_row"))
    stay = _components(by_id, least, k).select(F.col("least._row").alias("_row")).distinct()
    return numbered.join(stay, "_row", "left_semi").select(*docs.columns)
