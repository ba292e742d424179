"""Strict time splits and walk-forward fold plans.

``train``: period <= train_end; ``val``: train_end < period <= val_end;
``test``: period > val_end. Boundaries are inclusive quarter labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from panelcast.functions.periods import period_to_int

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class SplitConfig:
    train_end: int | str = "2018Q4"
    val_end: int | str = "2020Q4"

    @property
    def train_end_p(self) -> int:
        return period_to_int(self.train_end)

    @property
    def val_end_p(self) -> int:
        return period_to_int(self.val_end)


def split_label(cfg: SplitConfig, period: str = "period") -> Column:
    p = F.col(period)
    return (
        F.when(p <= cfg.train_end_p, "train")
        .when(p <= cfg.val_end_p, "val")
        .when(p.isNotNull(), "test")
    )


def with_split(df: DataFrame, cfg: SplitConfig, period: str = "period", name: str = "split") -> DataFrame:
    return df.withColumn(name, split_label(cfg, period))


def split_rows(df: DataFrame, split: str, cfg: SplitConfig, period: str = "period") -> DataFrame:
    """Rows of one split (pushed down as a range predicate on period)."""
    p = F.col(period)
    if split == "train":
        return df.where(p <= cfg.train_end_p)
    if split == "val":
        return df.where((p > cfg.train_end_p) & (p <= cfg.val_end_p))
    if split == "test":
        return df.where(p > cfg.val_end_p)
    raise ValueError(f"unknown split {split!r}; expected one of {SPLITS}")


@dataclass(frozen=True)
class Fold:
    fold: int
    train_end: int
    val_end: int


def plan_folds(periods: list[int], n_splits: int = 5, min_train: int = 24, val: int = 8) -> list[Fold]:
    """Expanding-window folds over the distinct periods.

    Fold ``i`` trains on the first ``min_train + i * step`` periods and
    validates on the ``val`` periods after them. The ``spare`` periods beyond
    the first fold's are dealt out evenly: ``step = max(1, spare // n_splits)``,
    and a fold starts at each multiple of ``step`` below ``spare``, up to
    ``n_splits`` of them. At least one spare period is needed.
    """
    calendar = sorted(set(periods))
    spare = len(calendar) - min_train - val
    if spare < 1:
        raise ValueError(f"walk-forward folds need at least {min_train + val + 1} periods; there are {len(calendar)}")
    step = max(1, spare // n_splits)
    count = min(n_splits, math.ceil(spare / step))
    train_sizes = [min_train + i * step for i in range(count)]
    return [Fold(i, calendar[n - 1], calendar[n + val - 1]) for i, n in enumerate(train_sizes)]


def distinct_periods_list(df: DataFrame, period: str = "period") -> list[int]:
    """Sorted distinct periods; bounded by the calendar (four per year)."""
    return [r[0] for r in df.select(period).distinct().orderBy(period).collect()]


FOLD_SCHEMA = StructType([
    StructField("fold", IntegerType(), False),
    StructField("train_end", IntegerType(), False),
    StructField("val_end", IntegerType(), False),
])


def fold_table(spark: SparkSession, folds: list[Fold]) -> DataFrame:
    return spark.createDataFrame([(f.fold, f.train_end, f.val_end) for f in folds], FOLD_SCHEMA)


def tag_folds(df: DataFrame, folds: list[Fold], period: str = "period") -> DataFrame:
    """Each row once per fold whose window contains it, with its ``role``
    (``train`` up to train_end, ``val`` up to val_end).

    The fold plan (at most ``n_splits`` entries) is a literal array, so this
    is a narrow ``inline`` over each row: no join and no shuffle.
    """
    plan = F.array(*[
        F.struct(F.lit(f.fold).alias("fold"), F.lit(f.train_end).alias("train_end"), F.lit(f.val_end).alias("val_end"))
        for f in folds
    ])
    p = F.col(period)
    hit = F.filter(plan, lambda f: p <= f["val_end"])
    tagged = df.select("*", F.inline(hit))
    return tagged.withColumn("role", F.when(p <= F.col("train_end"), "train").otherwise("val"))
