"""Scalar expressions: regimes, seasonality, labels, name cleaning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.periods import ColumnOrName, _col

# Left-closed cash-rate regime edges (percent).
# regime 0: < 1, 1: [1, 3), 2: [3, 6), 3: >= 6
RATE_REGIME_EDGES = (1.0, 3.0, 6.0)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN is never propagated: convert it to NULL once at the source."""
    x = _col(c)
    return F.when(~F.isnan(x), x)


def pct_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """Percent change ``(cur / prev - 1) * 100``; NULL on a zero or NULL base."""
    return (F.try_divide(_col(current), _col(previous)) - 1) * 100


def rate_regime(rate: ColumnOrName, edges: tuple[float, ...] = RATE_REGIME_EDGES) -> Column:
    """Ordinal bucket of a rate on left-closed edges; NULL stays NULL."""
    r = _col(rate)
    total = F.lit(0.0)
    for e in edges:
        total = total + (r >= F.lit(e)).cast("double")
    return F.when(r.isNotNull(), total)


def quarter_sin(quarter: ColumnOrName) -> Column:
    return F.sin(F.lit(2 * math.pi) * _col(quarter) / 4)


def quarter_cos(quarter: ColumnOrName) -> Column:
    return F.cos(F.lit(2 * math.pi) * _col(quarter) / 4)


def direction(x: ColumnOrName) -> Column:
    """'up' if > 0, 'down' if < 0, else 'flat'."""
    v = _col(x)
    return F.when(v > 0, "up").when(v < 0, "down").otherwise("flat")


def banded_direction(x: ColumnOrName, band: float = 0.1) -> Column:
    """'up' above +band, 'down' below -band, 'flat' in between."""
    v = _col(x)
    return F.when(v > band, "up").when(v < -band, "down").otherwise("flat")


def clean_series_name(raw: ColumnOrName) -> Column:
    """Last non-empty ``;``-separated token, trimmed; the trimmed text if none."""
    r = _col(raw)
    parts = F.filter(F.transform(F.split(r, ";"), lambda p: F.trim(p)), lambda p: p != "")
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.trim(r))


def pearson(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Pearson r as an aggregate, NULL (not an ANSI error) for a constant input.

    Pairwise complete like ``corr``: both moments only see rows where a and b
    are non-null."""
    x, y = _col(a), _col(b)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))
