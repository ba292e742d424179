"""Near-duplicate embeddings by product quantisation over inverted lists.

Coarse centroids (spherical k-means) split the vectors into lists; what a
vector differs from its centroid is coded by the nearest of 256 learned
residuals in each subspace. A query visits all groups of lists in which a
vector within the threshold of it may lie, and gets its inner products with
their coded vectors from one lookup table per subspace. The visits follow from
the geometry of the centroids alone, whatever the data. By Cauchy-Schwarz a
coded product errs by at most the length of what the code leaves over, which
is stored with the code: whatever may reach the threshold is reranked by exact
cosine in double precision, so no link is lost. Where the centroids do not
separate the vectors, all groups are visited.

Equal vectors are one class before anything is compared. Lists are compared in
blocks of bounded size; a block returns, per vector, how many links it has
there, and a spanning forest of the links, never all pairs.

Centroids and codes are fitted on a bounded sample (``SAMPLE`` vectors or
``SAMPLE_VALUES`` components, those with the least hash of their id); all
vectors are indexed and all are queries.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, materialize
from panelcast.llm.components import connected_components
from panelcast.session import ship_package

SAMPLE, SAMPLE_VALUES = 20_000, 1 << 22
#: vectors that a list should hold, and the most lists a sample can carry
LIST_SIZE, SAMPLE_PER_LIST = 256, 8
SUB_DIM, CODES = 8, 256
ROUNDS = 8
#: neighbouring lists that are visited together
GROUP_LISTS = 16
#: added to the bound on visits against rounding
ROUNDING = 1e-9
#: members and queries compared at a time
BLOCK_MEMBERS, BLOCK_QUERIES, QUERY_ROWS = 4096, 8192, 512
SEED = 5


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, without overflow on very large or small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, spherical: bool) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres, spherical)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        if spherical:
            norm = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.divide(centres, norm, out=centres, where=norm > 0)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, spherical: bool) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = 0.0 if spherical else 0.5 * (centres**2).sum(1)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = np.argmax(x[i : i + 4096] @ centres.T - half, axis=1)
    return out


@dataclass
class ProductQuantiser:
    dim: int  # a multiple of SUB_DIM; shorter vectors are padded with zeros
    threshold: float
    coarse: np.ndarray  # lists x dim, of length 1
    codebooks: np.ndarray  # subspaces x codes x SUB_DIM

    def padded(self, vectors: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(vectors), self.dim))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of unit vectors, and the length of what they leave over."""
        rest = x - self.coarse[home]
        codes = np.empty((len(x), len(self.codebooks)), np.uint8)
        for m, book in enumerate(self.codebooks):
            part = rest[:, m * SUB_DIM : (m + 1) * SUB_DIM]
            codes[:, m] = _nearest(part, book, spherical=False)
            rest[:, m * SUB_DIM : (m + 1) * SUB_DIM] = part - book[codes[:, m]]
        return codes, np.linalg.norm(rest, axis=1)

    def visited(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Flags of the lists that vectors within the threshold of ``x`` may be assigned to.

        ``y = t x + s u`` with ``u`` a unit vector across ``x`` prefers list ``c`` to the home
        list only if ``t x.(c - home) + s u.(c - home) >= 0``, and ``u.(c - home)`` is at most
        the length of ``c - home`` across ``x``; a larger ``t`` only lowers the sum.
        """
        t = self.threshold
        s = math.sqrt(max(0.0, 1 - t * t))
        products = x @ self.coarse.T
        behind = products[np.arange(len(x)), home][:, None] - products  # x.(home - c)
        norms = (self.coarse**2).sum(1)
        between = norms[home][:, None] + norms - 2 * (self.coarse[home] @ self.coarse.T)
        across = np.sqrt(np.maximum(0.0, between - behind**2))
        return t * behind <= s * across + ROUNDING

    def visited_groups(self, x: np.ndarray, home: np.ndarray) -> list[np.ndarray]:
        """Numbers, from the own one on, of the groups of lists that ``x`` visits; a pair of
        vectors in two groups is found by the one whose group has the smaller number."""
        lists = self.visited(x, home)
        lists[np.arange(len(x)), home] = True
        groups = np.logical_or.reduceat(lists, np.arange(0, lists.shape[1], GROUP_LISTS), axis=1)
        groups &= np.arange(groups.shape[1]) >= home[:, None] // GROUP_LISTS
        return [np.flatnonzero(g).astype(np.int32) for g in groups]


def fit(sample: np.ndarray, n: int, threshold: float) -> ProductQuantiser:
    """Fit on unit vectors for an index of ``n`` vectors."""
    rng = np.random.default_rng(SEED)
    lists = max(1, min(math.ceil(n / LIST_SIZE), len(sample) // SAMPLE_PER_LIST))
    coarse = _k_means(sample, lists, rng, spherical=True)
    rest = sample - coarse[_nearest(sample, coarse, spherical=True)]
    books = [_k_means(rest[:, i : i + SUB_DIM], min(CODES, len(sample)), rng, spherical=False)
             for i in range(0, sample.shape[1], SUB_DIM)]
    return ProductQuantiser(sample.shape[1], threshold, coarse, np.stack(books))


ENTRY_SCHEMA = "id long, weight long, home int, visits array<int>, code binary, rest double, vector binary"


def _index_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        for start in range(0, len(batch), 2048):
            part = batch.slice(start, 2048)
            raw = model.padded([np.array(v, float) for v in part.column(2).to_pylist()])
            x = unit_rows(raw)
            home = _nearest(x, model.coarse, spherical=True)
            codes, rest = model.encode(x, home)
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(home.astype(np.int32)),
                pa.array(model.visited_groups(x, home), pa.list_(pa.int32())),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(rest),
                pa.array([v.tobytes() for v in x], pa.binary()),
            ], ["id", "weight", "home", "visits", "code", "rest", "vector"])


def _forest(rows: np.ndarray, linked: list[np.ndarray], q_ids: np.ndarray, m_ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges between ids that connect what the links connect: query ``rows[i]`` is linked to members ``linked[i]``."""
    label = np.arange(len(m_ids))
    edges = []
    for q, members in zip(rows.tolist(), linked, strict=True):
        held = np.unique(label[members])
        edges.append((int(q_ids[q]), int(m_ids[held[0]])))
        if len(held) > 1:
            edges += [(int(m_ids[held[0]]), int(m_ids[h])) for h in held[1:]]
            label[np.isin(label, held[1:])] = held[0]
    return edges


def _compare(members: pa.Table, queries: pa.Table, model) -> pa.Table:
    """Links between one block of a group's members and one block of its queries."""
    model = model.value
    dim, subs = model.dim, len(model.codebooks)
    if not (members.num_rows and queries.num_rows):
        return pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()),
                         "other": pa.array([], pa.int64())})

    def read(t: pa.Table, column: str, kind: str, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(t.column(column).to_pylist()), kind).reshape(-1, width)

    m_ids, m_weight = members.column("id").to_numpy(), members.column("weight").to_numpy()
    q_ids, q_weight = queries.column("id").to_numpy(), queries.column("weight").to_numpy()
    m_home = members.column("home").to_numpy()
    inside = queries.column("home").to_numpy() // GROUP_LISTS == m_home[0] // GROUP_LISTS
    m_vectors, q_vectors = read(members, "vector", "<f8", dim), read(queries, "vector", "<f8", dim)
    codes, rest = read(members, "code", "u1", subs), members.column("rest").to_numpy()
    q_count, m_count = np.zeros(len(q_ids), np.int64), np.zeros(len(m_ids), np.int64)
    rows, linked = [], []
    for start in range(0, len(q_ids), QUERY_ROWS):
        q = q_vectors[start : start + QUERY_ROWS]
        estimate = (q @ model.coarse.T).astype(np.float32)[:, m_home]
        for m, book in enumerate(model.codebooks):
            table = (q[:, m * SUB_DIM : (m + 1) * SUB_DIM] @ book.T).astype(np.float32)
            estimate += table[:, codes[:, m]]
        at_q, at_m = np.nonzero(estimate >= (model.threshold - rest - 1e-5).astype(np.float32))
        at_q = at_q + start
        # within their own group both sides find a pair; it is the smaller id's
        own = ~inside[at_q] | (q_ids[at_q] < m_ids[at_m])
        at_q, at_m = at_q[own], at_m[own]
        near = np.zeros(len(at_q), bool)
        for i in range(0, len(at_q), 1 << 15):
            s = slice(i, i + (1 << 15))
            near[s] = np.einsum("ij,ij->i", q_vectors[at_q[s]], m_vectors[at_m[s]]) >= model.threshold
        at_q, at_m = at_q[near], at_m[near]
        np.add.at(q_count, at_q, m_weight[at_m])
        np.add.at(m_count, at_m, q_weight[at_q])
        if len(at_q):
            first = np.flatnonzero(np.r_[True, at_q[1:] != at_q[:-1]])
            rows.append(at_q[first])
            linked += np.split(at_m, first[1:])
    edges = _forest(np.concatenate(rows), linked, q_ids, m_ids) if rows else []
    ids = np.concatenate([q_ids[q_count > 0], m_ids[m_count > 0], [a for a, _ in edges]]).astype(np.int64)
    n = np.concatenate([q_count[q_count > 0], m_count[m_count > 0], np.zeros(len(edges))]).astype(np.int64)
    other = pa.array([*[None] * (len(ids) - len(edges)), *[b for _, b in edges]], pa.int64())
    return pa.table({"id": ids, "n": n, "other": other})


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """Links of all vectors by cosine of at least ``threshold``.

    Returns ``vec_id, n_links, component_id, kept``, a row per id: how many
    other vectors are linked directly, the smallest id that links reach,
    itself included, and whether that is its own. A vector that is null, empty, zero
    or holds null or non-finite components links with nothing; neither does
    a row without an id, for which one row with null ids, 0 and false stands. Rows with
    the same id are one vector, the smallest in array order. Shorter vectors
    are taken as padded with zeros. Other columns are not read; an empty
    table gives an empty table.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = F.expr("id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) "
                    "and abs(x) < double('inf')) and exists(v, x -> x <> 0)")
    rows = rows.groupBy("id").agg(F.min(F.when(F.coalesce(usable, F.lit(False)), F.col("v"))).alias("v"))
    rows = materialize(rows, "quantise-vectors")
    valid = rows.where("v is not null")
    classes = materialize(valid.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")),
                          "quantise-classes")
    n, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    dim = math.ceil(width / SUB_DIM) * SUB_DIM
    bound = max(1, min(SAMPLE, SAMPLE_VALUES // dim))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(bound).select("v").toArrow().column("v").to_pylist()
    padded = np.zeros((len(sample), dim))
    for i, v in enumerate(sample):
        padded[i, : len(v)] = v
    model = spark.sparkContext.broadcast(fit(unit_rows(padded), n, threshold))  # bounded by the sample

    indexed = materialize(arrow_map(classes.select("id", "weight", "v"), functools.partial(_index_batches, model=model),
                                    ENTRY_SCHEMA), "quantise-index")
    visits = indexed.select("id", "weight", "home", "vector", F.explode("visits").alias("group"))
    # a row per group: blocks of members and of queries
    grouped = indexed.withColumn("group", F.expr(f"home div {GROUP_LISTS}").cast("int"))
    size = grouped.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("m"))
    asked = visits.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("q"))
    blocks = F.broadcast(materialize(size.join(asked, "group"), "quantise-blocks"))  # a row per group of the model
    spread = F.xxhash64("id", F.lit(1))
    members = grouped.join(blocks, "group").select(
        "group", F.pmod(spread, "m").alias("mb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1)).alias("qb"),
        "id", "weight", "home", "code", "rest", "vector")
    queries = visits.join(blocks, "group").select(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("mb"),
        F.pmod(spread, "q").alias("qb"), "id", "weight", "home", "vector")
    queries = queries.toDF(*queries.columns)  # columns of its own, beside those of members
    key = ["group", "mb", "qb"]
    found = materialize(members.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(
        functools.partial(_compare, model=model), "id long, n long, other long"), "quantise-links")

    roots = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    own = classes.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "id").alias("root"))
    return rows.join(own, "v", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("root", "id"), F.lit(False)).alias("kept"))
