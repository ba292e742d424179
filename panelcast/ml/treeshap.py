"""Additive tree attributions (path-dependent Tree SHAP) as a table join.

A forest becomes a table with one row per leaf: tree, value, and per feature of its path the
interval that agrees with the leaf and the share of training rows that pass its splits (Lundberg et al.,
"Consistent individualized feature attribution for tree ensembles"). Rows are
joined with the leaves of every tree; a leaf's Shapley values are column
expressions, and are added up by row and feature.

With ``o`` (1 if a feature agrees, else 0) and ``z`` (its share), feature j of a leaf with value v gets

    v * (o_j - z_j) * integral over t in [0, 1] of product over k != j of (z_k (1 - t) + o_k t)

which is the Shapley sum over all sets of the other features, since the weight of a
set of s of m - 1 others is the integral of t^s (1 - t)^(m-1-s). The integrand is a polynomial, so
Gauss-Legendre nodes give the integral exactly. Per row, values and base value add up to the prediction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.ml.forest import Forest
from panelcast.session import stored

#: a leaf table of up to this many path entries (about 64 MB) is broadcast, a larger one is joined by shuffling
BROADCAST_ENTRIES = 2_000_000

LEAF_SCHEMA = "tree int, value double, path array<struct<feature:int,low:double,high:double,share:double>>"


def leaf_rows(forest: Forest) -> list[tuple[int, float, list[tuple[int, float, float, float]]]]:
    """Leaves with at least one feature on their path: tree, value, path."""
    out = []
    for tree, root in enumerate(forest.starts.tolist()):
        stack: list[tuple[int, dict]] = [(root, {})]
        while stack:
            node, path = stack.pop()
            child = int(forest.left[node])
            if child < 0:
                if path and forest.value[node] != 0.0:
                    out.append((tree, float(forest.value[node]), [(f, *b) for f, b in sorted(path.items())]))
                continue
            f, cut = int(forest.feature[node]), float(forest.threshold[node])
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for to, bounds in ((child, (low, min(high, cut))), (child + 1, (max(low, cut), high))):
                part = share * float(forest.cover[to]) / float(forest.cover[node])
                stack.append((to, {**path, f: (*bounds, part)}))
    return out


def expected_value(forest: Forest) -> float:
    """Prediction without any feature: each tree's leaves weighted by their training rows."""
    leaf = forest.left < 0
    tree = np.repeat(np.arange(forest.n_trees), np.diff(np.append(forest.starts, len(forest.left))))
    weight = forest.cover / np.maximum(forest.cover[forest.starts][tree], 1e-300) if forest.n_trees else forest.cover
    return forest.init + float((forest.value * weight)[leaf].sum())


def _shapley(longest: int) -> tuple[str, str, str]:
    """SQL for the contributions of one leaf to row ``x``: agreements, products at the nodes, (feature, value) array."""
    nodes, weights = np.polynomial.legendre.leggauss(max(1, -(-longest // 2)))
    at = [(float((1 - t) / 2), float((1 + t) / 2), float(w / 2)) for t, w in zip(nodes, weights, strict=True)]
    agreed = ("transform(path, p -> struct(p.feature as feature, p.share as z, "
              "if(x[p.feature] > p.low and x[p.feature] <= p.high, 1D, 0D) as o))")
    products = ", ".join(f"aggregate(terms, 1D, (a, t) -> a * (t.z * {u!r}D + t.o * {v!r}D))" for u, v, _ in at)
    total = " + ".join(f"{w!r}D * products[{i}] / (t.z * {u!r}D + t.o * {v!r}D)" for i, (u, v, w) in enumerate(at))
    return agreed, f"array({products})", f"transform(terms, t -> struct(t.feature as feature, value * (t.o - t.z) * ({total}) as v))"


def attributions(df: DataFrame, forest: Forest, values: str = "shap_values", base: str = "base_value") -> DataFrame:
    """``df``, each row once, with the contributions (map feature -> value) and the base value.

    Features must not be null. Rows are numbered, so repeated keys stay apart.
    """
    spark: SparkSession = df.sparkSession
    names = forest.feature_cols
    base_value = F.lit(expected_value(forest))
    leaves = leaf_rows(forest)
    if not leaves:
        zero = F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.lit(0.0)] * len(names)))
        return df.withColumns({values: zero, base: base_value})
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "attributed-rows")
    x = rows.select("_row", F.array(*[F.col(c).cast("double") for c in names]).alias("x"))
    each = x.select("_row", "x", F.explode(F.sequence(F.lit(0), F.lit(forest.n_trees - 1))).alias("tree"))
    table = spark.createDataFrame(leaves, LEAF_SCHEMA)
    if sum(len(p) for _, _, p in leaves) <= BROADCAST_ENTRIES:
        table = F.broadcast(table)
    agreed, products, shares = _shapley(max(len(p) for _, _, p in leaves))
    hit = each.join(table, "tree").withColumn("terms", F.expr(agreed)).withColumn("products", F.expr(products))
    parts = hit.select("_row", F.inline(F.expr(shares)))
    sums = parts.groupBy("_row", "feature").agg(F.sum("v").alias("v"))
    by_row = sums.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("feature", "v"))).alias("_found"))
    keys = F.array(*[F.lit(c) for c in names])
    full = F.array(*[F.coalesce(F.col("_found")[i], F.lit(0.0)) for i in range(len(names))])
    return rows.join(by_row, "_row", "left").withColumns(
        {values: F.map_from_arrays(keys, full), base: base_value}).drop("_row", "_found")
