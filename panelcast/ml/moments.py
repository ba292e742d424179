"""Moment matrices of (1, x, y) per group, as built-in sums of products.

Each row is a vector ``v = [1, x..., y]``; it is exploded into its places, and per
(group, place) one sum of products with every place is kept. Partial sums are made
before the shuffle, so it carries (groups x (d + 2)) rows per task; the driver gets groups x (d + 2)^2
numbers, independent of the row count. No row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram_by_group(df: DataFrame, cols: Sequence[str], y: str, group: str | None = None) -> dict[int, np.ndarray]:
    """{group: G} with G = sum over rows of v v^T, v = [1, x_1..x_d, y].

    Rows with a null in ``cols`` or ``y`` must be removed by the caller.
    """
    k = len(cols) + 2
    g = F.col(group).cast("int") if group else F.lit(0)
    vector = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in (*cols, y)])
    places = df.select(g.alias("grp"), vector.alias("v")).select("grp", "v", F.posexplode("v").alias("i", "e"))
    sums = places.groupBy("grp", "i").agg(*[F.sum(F.col("e") * F.col("v")[j]).alias(f"s{j}") for j in range(k)])
    out: dict[int, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["grp"], np.zeros((k, k)))[r["i"]] = [r[f"s{j}"] for j in range(k)]
    return out


def moments_by_period(df: DataFrame, cols: Sequence[str], period: str = "period") -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """{period: (rows, means, sums of squared deviations)}, in one aggregate; bounded by the calendar."""
    rows = df.groupBy(period).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)]).collect()
    d = range(len(cols))
    return {r[period]: (r["n"], np.array([float(r[f"m{i}"]) for i in d]),
                        r["n"] * np.array([float(r[f"v{i}"]) for i in d])) for r in rows}


def pooled(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and sums of squared deviations of several parts together."""
    n, mean, square = parts[0]
    for n_b, mean_b, square_b in parts[1:]:
        shift, total = mean_b - mean, n + n_b
        square = square + square_b + shift * shift * (n * n_b / total)
        mean, n = mean + shift * (n_b / total), total
    return n, mean, square


def restandardised(g: np.ndarray, mean: np.ndarray, scale: np.ndarray, to_mean: np.ndarray,
                   to_scale: np.ndarray) -> np.ndarray:
    """The moment matrix of rows standardised by (mean, scale), as if by (to_mean, to_scale)."""
    t = np.eye(len(g))
    for j in range(len(mean)):
        t[j + 1, j + 1] = scale[j] / to_scale[j]
        t[j + 1, 0] = (mean[j] - to_mean[j]) / to_scale[j]
    return t @ g @ t.T
