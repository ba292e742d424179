"""Leak-free panel features as window expressions.

Every window is ``partitionBy(entity).orderBy(period)``: the whole feature
build needs one hash exchange on ``entity`` and one sort, regardless of how
many features are derived. Shifts are positional (row based): a gap in the
periods is skipped over, as in the row-shift semantics of the model.
A partition holds one entity's periods, so its size is bounded by the
calendar (four rows per year), never by the data volume.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.functions.periods import period_quarter
from panelcast.functions.scalars import pct_change, pearson, quarter_cos, quarter_sin, rate_regime

PRICE = "price"
TARGET = "target"

NUMERIC_FEATURES = [
    "rppi_lag_1",
    "rppi_lag_2",
    "rppi_lag_4",
    "rppi_qoq_pct_lag1",
    "rppi_yoy_pct_lag1",
    "rolling_mean_4q",
    "rolling_std_4q",
    "momentum_streak_lag1",
    "price_acceleration_lag1",
    "cash_rate_lag1",
    "cash_rate_delta_lag1",
    "rate_regime",
    "cpi_lag1",
    "cpi_yoy_pct_lag1",
    "unemp_lag1",
    "unemp_delta_lag1",
    "quarter",
    "quarter_sin",
    "quarter_cos",
]


def dummy_name(value: str, prefix: str = "entity_") -> str:
    return prefix + re.sub(r"[^0-9A-Za-z]+", "_", value).strip("_")


def feature_columns(vocabulary: Sequence[str], prefix: str = "entity_") -> list[str]:
    """Ordered model inputs: 19 numeric features then one dummy per entity."""
    return NUMERIC_FEATURES + [dummy_name(v, prefix) for v in vocabulary]


def panel_window(entity: str = "entity", period: str = "period") -> WindowSpec:
    return Window.partitionBy(entity).orderBy(period)


def _w(entity: str, period: str) -> WindowSpec:
    return panel_window(entity, period)


def add_price_lags(
    df: DataFrame, lags: Sequence[int] = (1, 2, 4), *, price: str = PRICE,
    entity: str = "entity", period: str = "period",
) -> DataFrame:
    w = _w(entity, period)
    return df.withColumns({f"rppi_lag_{k}": F.lag(price, k).over(w) for k in lags})


def add_price_changes(
    df: DataFrame, *, price: str = PRICE, entity: str = "entity", period: str = "period",
) -> DataFrame:
    """rppi_qoq_pct (1 row back) and rppi_yoy_pct (4 rows back), in percent."""
    w = _w(entity, period)
    return df.withColumns({
        "rppi_qoq_pct": pct_change(F.col(price), F.lag(price, 1).over(w)),
        "rppi_yoy_pct": pct_change(F.col(price), F.lag(price, 4).over(w)),
    })


def rolling_mean_std(
    x: str, window: int, min_periods: int, w: WindowSpec,
) -> tuple[Column, Column]:
    """Mean and sample std of the ``window`` rows before the current one,
    NULL unless at least ``min_periods`` of them are non-null."""
    frame = w.rowsBetween(-window, -1)
    enough = F.count(x).over(frame) >= min_periods
    return F.when(enough, F.avg(x).over(frame)), F.when(enough, F.stddev_samp(x).over(frame))


def add_rolling_stats(
    df: DataFrame, *, change: str = "rppi_qoq_pct", window: int = 4, min_periods: int = 2,
    entity: str = "entity", period: str = "period",
) -> DataFrame:
    mean, std = rolling_mean_std(change, window, min_periods, _w(entity, period))
    return df.withColumns({"rolling_mean_4q": mean, "rolling_std_4q": std})


def add_lagged_changes(df: DataFrame, *, entity: str = "entity", period: str = "period") -> DataFrame:
    w = _w(entity, period)
    return df.withColumns({
        "rppi_qoq_pct_lag1": F.lag("rppi_qoq_pct", 1).over(w),
        "rppi_yoy_pct_lag1": F.lag("rppi_yoy_pct", 1).over(w),
    })


def signed_streak(x: str, w: WindowSpec) -> Column:
    """Signed run length of the sign of ``x``.

    +n after n positive values in a row, -n after n negative ones; a zero
    gives 0 and a NULL gives NULL, and both restart the count. A run starts
    where the sign differs (null-safe) from the previous row; the start row
    number is carried forward with a running max, so no second sort is needed.
    """
    s = F.signum(F.col(x))
    rn = F.row_number().over(w)
    starts = F.when((rn == 1) | ~s.eqNullSafe(F.lag(s, 1).over(w)), rn)
    start = F.max(starts).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s * (rn - start + 1)


def add_momentum_features(
    df: DataFrame, *, change: str = "rppi_qoq_pct", entity: str = "entity", period: str = "period",
) -> DataFrame:
    w = _w(entity, period)
    out = df.withColumn("momentum_streak", signed_streak(change, w))
    out = out.withColumn("price_accel", F.col(change) - F.lag(change, 1).over(w))
    return out.withColumns({
        "momentum_streak_lag1": F.lag("momentum_streak", 1).over(w),
        "price_acceleration_lag1": F.lag("price_accel", 1).over(w),
    })


def add_cash_rate_features(
    df: DataFrame, *, rate: str = "cash_rate", entity: str = "entity", period: str = "period",
) -> DataFrame:
    w = _w(entity, period)
    out = df.withColumns({
        "cash_rate_delta": F.col(rate) - F.lag(rate, 1).over(w),
        "cash_rate_lag1": F.lag(rate, 1).over(w),
    })
    return out.withColumn("cash_rate_delta_lag1", F.lag("cash_rate_delta", 1).over(w))


def add_cpi_features(
    df: DataFrame, *, cpi: str = "cpi", entity: str = "entity", period: str = "period",
) -> DataFrame:
    w = _w(entity, period)
    out = df.withColumns({
        "cpi_yoy_pct": pct_change(F.col(cpi), F.lag(cpi, 4).over(w)),
        "cpi_lag1": F.lag(cpi, 1).over(w),
    })
    return out.withColumn("cpi_yoy_pct_lag1", F.lag("cpi_yoy_pct", 1).over(w))


def add_unemployment_features(
    df: DataFrame, *, unemp: str = "unemployment_rate", entity: str = "entity", period: str = "period",
) -> DataFrame:
    w = _w(entity, period)
    out = df.withColumns({
        "unemp_delta": F.col(unemp) - F.lag(unemp, 1).over(w),
        "unemp_lag1": F.lag(unemp, 1).over(w),
    })
    return out.withColumn("unemp_delta_lag1", F.lag("unemp_delta", 1).over(w))


def add_rate_regime(df: DataFrame, *, rate: str = "cash_rate_lag1") -> DataFrame:
    return df.withColumn("rate_regime", rate_regime(rate))


def add_seasonal_features(df: DataFrame, *, period: str = "period") -> DataFrame:
    out = df.withColumn("quarter", period_quarter(period))
    return out.withColumns({"quarter_sin": quarter_sin("quarter"), "quarter_cos": quarter_cos("quarter")})


def add_entity_dummies(
    df: DataFrame, vocabulary: Sequence[str], *, entity: str = "entity", prefix: str = "entity_",
) -> DataFrame:
    """One int column per listed value (fixed vocabulary); unknown -> all 0."""
    return df.withColumns({
        dummy_name(v, prefix): (F.col(entity) == F.lit(v)).cast("int") for v in vocabulary
    })


def add_sparse_entity(df: DataFrame, *, entity: str = "entity", out: str = "entity_vec") -> DataFrame:
    """The same one-hot code as one sparse vector column, for any number of
    entities: a row carries one index, however wide the code is. Indices follow
    the names' order; NULL gives the empty vector. Entities are numbered in
    sorted ranges; no label reaches the driver."""
    from pyspark.ml.feature import OneHotEncoder

    from panelcast.operators.offsets import entity_index

    at, index = f"_{out}_at", entity_index(df, entity).select(F.col(entity).alias("_name"), "idx")
    n = index.count()
    joined = df.join(index, F.col(entity) == F.col("_name"), "left").drop("_name")
    wide = {"ml_attr": {"type": "nominal", "name": at, "num_vals": n + 1}}  # the last value is "none of them"
    indexed = joined.withColumn(at, F.coalesce(F.col("idx"), F.lit(n)).cast("double").alias(at, metadata=wide)).drop("idx")
    encoder = OneHotEncoder(inputCols=[at], outputCols=[out], dropLast=True)
    return encoder.fit(indexed).transform(indexed).drop(at)


def add_target(
    df: DataFrame, *, price: str = PRICE, entity: str = "entity", period: str = "period",
) -> DataFrame:
    """target = next row's rppi_qoq_pct (computed first if absent)."""
    if "rppi_qoq_pct" not in df.columns:
        df = add_price_changes(df, price=price, entity=entity, period=period)
    return df.withColumn(TARGET, F.lead("rppi_qoq_pct", 1).over(_w(entity, period)))


def add_all_features(
    panel: DataFrame, vocabulary: Sequence[str], *, with_target: bool = True,
    entity: str = "entity", period: str = "period", prefix: str = "entity_",
    dummy_col: str | None = None,
) -> DataFrame:
    """All derived columns, before null filtering.

    Same columns as chaining the ``add_*`` functions, built as four
    projections (one per dependency level) so the analyser sees a shallow
    plan; every window shares ``partitionBy(entity).orderBy(period)``, so the
    physical plan has one exchange and one sort. Windows are partitioned by
    ``entity``; dummies encode ``dummy_col`` (default: ``entity``), e.g.
    windows per request id and dummies per name.
    """
    w = _w(entity, period)
    lag = lambda c, k=1: F.lag(c, k).over(w)
    c = F.col
    level1 = {
        "rppi_lag_1": lag(PRICE), "rppi_lag_2": lag(PRICE, 2), "rppi_lag_4": lag(PRICE, 4),
        "rppi_qoq_pct": pct_change(c(PRICE), lag(PRICE)),
        "rppi_yoy_pct": pct_change(c(PRICE), lag(PRICE, 4)),
        "cash_rate_delta": c("cash_rate") - lag("cash_rate"), "cash_rate_lag1": lag("cash_rate"),
        "cpi_yoy_pct": pct_change(c("cpi"), lag("cpi", 4)), "cpi_lag1": lag("cpi"),
        "unemp_delta": c("unemployment_rate") - lag("unemployment_rate"), "unemp_lag1": lag("unemployment_rate"),
        "_rn": F.row_number().over(w),
        "quarter": period_quarter(period),
    }
    df = panel.select("*", *[v.alias(k) for k, v in level1.items()])
    sign = F.signum(c("rppi_qoq_pct"))
    mean, std = rolling_mean_std("rppi_qoq_pct", 4, 2, w)
    level2 = {
        "rolling_mean_4q": mean, "rolling_std_4q": std,
        "rppi_qoq_pct_lag1": lag("rppi_qoq_pct"), "rppi_yoy_pct_lag1": lag("rppi_yoy_pct"),
        "price_accel": c("rppi_qoq_pct") - lag("rppi_qoq_pct"),
        "cash_rate_delta_lag1": lag("cash_rate_delta"),
        "cpi_yoy_pct_lag1": lag("cpi_yoy_pct"),
        "unemp_delta_lag1": lag("unemp_delta"),
        "rate_regime": rate_regime("cash_rate_lag1"),
        "quarter_sin": quarter_sin("quarter"), "quarter_cos": quarter_cos("quarter"),
        "_start": F.when((c("_rn") == 1) | ~sign.eqNullSafe(F.lag(sign, 1).over(w)), c("_rn")),
    }
    if with_target:
        level2[TARGET] = F.lead("rppi_qoq_pct", 1).over(w)
    df = df.select("*", *[v.alias(k) for k, v in level2.items()])
    run_start = F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.select("*", (sign * (c("_rn") - run_start + 1)).alias("momentum_streak"))
    dummies = {dummy_name(v, prefix): (c(dummy_col or entity) == F.lit(v)).cast("int") for v in vocabulary}
    return df.select(
        *[x for x in df.columns if x not in ("_rn", "_start")],
        lag("momentum_streak").alias("momentum_streak_lag1"),
        lag("price_accel").alias("price_acceleration_lag1"),
        *[v.alias(k) for k, v in dummies.items()],
    )


def build_features(
    panel: DataFrame, vocabulary: Sequence[str], *, entity: str = "entity",
    period: str = "period", prefix: str = "entity_",
) -> DataFrame:
    """Training matrix: rows with a target and every feature present."""
    df = add_all_features(panel, vocabulary, with_target=True, entity=entity, period=period, prefix=prefix)
    return df.dropna(subset=[TARGET] + feature_columns(vocabulary, prefix))


def build_inference(
    panel: DataFrame, vocabulary: Sequence[str], *, entity: str = "entity",
    period: str = "period", prefix: str = "entity_", dummy_col: str | None = None,
) -> DataFrame:
    """Like :func:`build_features` but keeps rows whose target is unknown."""
    df = add_all_features(panel, vocabulary, with_target=False, entity=entity, period=period, prefix=prefix,
                          dummy_col=dummy_col)
    return df.dropna(subset=feature_columns(vocabulary, prefix))


def latest_rows(
    features: DataFrame, *, entity: str = "entity", period: str = "period",
) -> DataFrame:
    """Last complete feature row per entity plus the period it predicts.

    ``max_by`` over a struct keeps one row per entity with a hash aggregate
    (no sort); ``predict_period`` is the quarter after the row's period.
    """
    cols = [c for c in features.columns if c != entity]
    latest = features.groupBy(entity).agg(F.max_by(F.struct(*cols), F.col(period)).alias("r"))
    return latest.select(entity, "r.*").withColumn("predict_period", (F.col(period) + 1).cast("int"))


def rebase(
    df: DataFrame, value: str = PRICE, *, base: float = 100.0, entity: str = "entity",
    period: str = "period", name: str | None = None,
) -> DataFrame:
    """value / (first value of the entity) * base."""
    w = _w(entity, period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name or f"{value}_rebased", F.col(value) / F.first(value, ignorenulls=False).over(w) * base)


def autocorrelation(
    df: DataFrame, value: str, max_lag: int = 8, *, entity: str = "entity", period: str = "period",
) -> DataFrame:
    """Per lag k: mean over entities of corr(x_t, x_{t-k}) (pairwise complete),
    with the 1.96/sqrt(n) band of the mean series length.

    The lagged columns come from one window pass; the correlations are one
    grouped aggregate per entity, then a tiny aggregate across entities.
    """
    w = _w(entity, period)
    lagged = df.select(entity, value, *[F.lag(value, k).over(w).alias(f"l{k}") for k in range(1, max_lag + 1)])
    per_entity = lagged.groupBy(entity).agg(
        F.count(value).alias("n"),
        *[pearson(value, f"l{k}").alias(f"c{k}") for k in range(1, max_lag + 1)],
    )
    stacked = per_entity.select(
        entity, "n",
        F.inline(F.array(*[
            F.struct(F.lit(k).alias("lag"), F.col(f"c{k}").alias("acf")) for k in range(1, max_lag + 1)
        ])),
    )
    return stacked.groupBy("lag").agg(
        F.avg("acf").alias("acf"),
        (F.lit(1.96) / F.sqrt(F.avg("n"))).alias("band"),
        F.count("acf").alias("n_entities"),
    )
