"""Calendar alignment of native-frequency series to quarters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.periods import period_of


def resample_to_quarter(
    obs: DataFrame,
    method: str | dict[str, str] = "last",
    *,
    series: str = "series_id",
    date: str = "obs_date",
    value: str = "value",
    order_by: str | None = None,
) -> DataFrame:
    """(series, period, value) per calendar quarter.

    ``'last'`` keeps the last non-null observation by ``date`` (``order_by``
    breaks ties, e.g. a row index); any other method string is the mean.
    ``method`` may map series ids to methods. Empty quarters are absent.
    One shuffle on (series, period) after a map-side partial aggregate.
    """
    key = F.col(date) if order_by is None else F.struct(F.col(date), F.col(order_by))
    grouped = (
        obs.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
        .groupBy(F.col(series).alias(series), period_of(date).alias("period"))
    )
    if isinstance(method, str):
        agg = F.max_by(value, key) if method == "last" else F.avg(value)
        return grouped.agg(agg.alias(value))
    last_ids = [s for s, m in method.items() if m == "last"]
    chosen = F.when(F.col(series).isin(last_ids), F.max_by(value, key)).otherwise(F.avg(value))
    return grouped.agg(chosen.alias(value))
