"""A forest of regression trees as node arrays: scoring, importance, storage.

The arrays are bounded by the model (trees x nodes), never by the data. They
travel with the task closure; ``scores`` walks all trees of any number of forests
for a batch of rows in one vectorised step, so a plan has one node however
many trees there are. As a table a forest has one row per node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ship_package

#: rows walked at a time: rows x trees nodes are held
WALK_CELLS = 1 << 21

NODE_SCHEMA = ("tree long, node long, feature long, threshold double, left long, value double, cover double, "
               "gain double")


@dataclass
class Forest:
    """``left`` is the left child's place in the arrays (the right one's is next to it) or -1 for a leaf; a row
    goes left if its feature is at most the threshold. The prediction is ``init`` plus the leaves' values."""

    feature_cols: list[str]
    init: float
    starts: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @property
    def n_trees(self) -> int:
        return len(self.starts)

    def depth(self) -> int:
        level = np.zeros(len(self.left), np.int64)
        for node in np.flatnonzero(self.left >= 0):  # children come after their parent
            level[self.left[node]] = level[self.left[node] + 1] = level[node] + 1
        return int(level.max()) if len(level) else 0

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features; a missing feature goes right."""
        out = np.full(len(x), self.init)
        if not self.n_trees:
            return out
        levels, step = self.depth(), max(1, WALK_CELLS // self.n_trees)
        feature, child = np.maximum(self.feature, 0), self.left
        for first in range(0, len(x), step):
            part = x[first : first + step]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.starts, (len(part), self.n_trees)).copy()
            for _ in range(levels):
                to = child[node]
                right = ~(part[rows, feature[node]] <= self.threshold[node])
                node = np.where(to >= 0, to + right, node)
            out[first : first + step] += self.value[node].sum(axis=1)
        return out

    def importance(self) -> list[tuple[str, float]]:
        """Share of each feature in the gains of all splits, largest first."""
        inner = self.left >= 0
        total = np.bincount(self.feature[inner], self.gain[inner], len(self.feature_cols))
        total = total / total.sum() if total.sum() > 0 else total
        return sorted(zip(self.feature_cols, total.tolist(), strict=True), key=lambda t: (-t[1], t[0]))

    # -- storage ---------------------------------------------------------------

    def table(self, spark: SparkSession) -> DataFrame:
        tree = np.repeat(np.arange(self.n_trees), np.diff(np.append(self.starts, len(self.left))))
        return spark.createDataFrame(pd.DataFrame({
            "tree": tree, "node": np.arange(len(self.left)), "feature": self.feature, "threshold": self.threshold,
            "left": self.left, "value": self.value, "cover": self.cover, "gain": self.gain}), NODE_SCHEMA)

    @classmethod
    def from_table(cls, nodes: DataFrame, feature_cols: list[str], init: float) -> Forest:
        t = nodes.toPandas().sort_values("node")  # one row per node of the model
        tree = t["tree"].to_numpy(np.int64)
        starts = np.flatnonzero(np.diff(tree, prepend=-1)) if len(tree) else np.zeros(0, np.int64)
        return cls(list(feature_cols), init, starts, *(t[c].to_numpy(d) for c, d in (
            ("feature", np.int64), ("threshold", float), ("left", np.int64), ("value", float), ("cover", float),
            ("gain", float))))


def scores(df: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """``df`` with one column per forest, all walked in one pass over Arrow batches.

    The forests need the same features. A null feature is missing and goes
    right at every split on it. The plan does not grow with the number of trees or forests.
    """
    ship_package(df.sparkSession)
    every = list(forests.values())
    cols, names = every[0].feature_cols, list(forests)
    if any(f.feature_cols != cols for f in every):
        raise ValueError("forests scored together need the same features")
    schema = ", ".join(f"s{i} double" for i in range(len(every)))

    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in batch])
            yield pd.DataFrame({f"s{i}": f.predict(x) for i, f in enumerate(every)})

    # the types are given here, as the closure's annotations are strings
    walk.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(walk, schema)
    scored = df.withColumn("_scores", udf(*[F.col(c).cast("double") for c in cols]))
    return scored.withColumns({n: F.col(f"_scores.s{i}") for i, n in enumerate(names)}).drop("_scores")
