"""Joins and set operations of the panel build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_drivers(
    quarterly: DataFrame,
    names: Sequence[str],
    *,
    series: str = "series_id",
    value: str = "value",
) -> DataFrame:
    """Wide (period, *names) table of the quarters where every series exists.

    Equivalent to an inner join of the series on period, done as a single
    pivot aggregate (one shuffle) with an explicit value list.
    """
    wide = (
        quarterly.groupBy("period")
        .pivot(series, list(names))
        .agg(F.max(value))
    )
    return wide.dropna(subset=list(names))


def attach_drivers(prices: DataFrame, drivers: DataFrame) -> DataFrame:
    """Inner join of per-entity observations with the national drivers.

    ``drivers`` holds at most one row per quarter; the optimizer broadcasts it
    when its measured size allows.
    """
    return prices.join(drivers, "period")


def union_panels(*panels: DataFrame) -> DataFrame:
    """UNION ALL of panels with the same columns (by name)."""
    out = panels[0]
    for p in panels[1:]:
        out = out.unionByName(p)
    return out
