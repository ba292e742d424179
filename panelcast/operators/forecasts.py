"""Long prediction frame ``(model, split, entity, period, y, pred, lo, hi)``.

Forecasters are column expressions over the feature matrix (baselines) or
fitted Spark ML models (``panelcast.ml``). Fitting an interval or a blend
only needs one tiny aggregate per model on the validation rows; the
per-row work is a narrow projection that stacks the models with ``inline``
(one pass, no union re-scan of the features).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.evaluation import inverse_mae_weights, z_value
from panelcast.operators.splits import SplitConfig, split_label

# Baseline forecasters of the next-quarter change: feature columns used as-is.
BASELINES = {"naive": "rppi_qoq_pct_lag1", "rolling_mean": "rolling_mean_4q"}

ENSEMBLE = "ensemble"


def wide_predictions(
    features: DataFrame, cfg: SplitConfig, preds: Mapping[str, object], *,
    entity: str = "entity", period: str = "period", target: str = "target",
) -> DataFrame:
    """(entity, period, split, y, pred_<model>...) from column expressions."""
    cols = {f"pred_{m}": (F.col(c) if isinstance(c, str) else c) for m, c in preds.items()}
    return features.select(
        F.col(entity).alias("entity"), F.col(period).alias("period"),
        split_label(cfg, period).alias("split"), F.col(target).alias("y"),
        *[c.alias(n) for n, c in cols.items()],
    )


def stack(wide: DataFrame, models: Sequence[str], with_bounds: bool) -> DataFrame:
    def item(m: str):
        fields = [F.lit(m).alias("model"), F.col(f"pred_{m}").alias("pred")]
        if with_bounds:
            fields += [F.col(f"lo_{m}").alias("lo"), F.col(f"hi_{m}").alias("hi")]
        return F.struct(*fields)

    return wide.select("entity", "period", "split", "y", F.inline(F.array(*[item(m) for m in models])))


def validation_stats(wide: DataFrame, models: Sequence[str]) -> dict[str, tuple[float, float]]:
    """model -> (population std of residuals, MAE) on the val split.

    One aggregate with two numbers per model; only that tiny row reaches the driver."""
    exprs = []
    for m in models:
        r = F.col("y") - F.col(f"pred_{m}")
        exprs += [F.stddev_pop(r).alias(f"sd_{m}"), F.avg(F.abs(r)).alias(f"mae_{m}")]
    row = wide.where(F.col("split") == "val").agg(*exprs).first()
    return {m: (row[f"sd_{m}"] or 0.0, row[f"mae_{m}"]) for m in models}


def validation_scalars(wide: DataFrame, models: Sequence[str]) -> Column:
    """One scalar subquery (a struct) with ``sd_<m>`` (population std of
    residuals) and ``mae_<m>`` per model over the validation rows.

    It stays inside the query: the subquery reuses the main plan's feature
    exchange, so the source tables are read once."""
    exprs = []
    for m in models:
        r = F.col("y") - F.col(f"pred_{m}")
        exprs += [F.stddev_pop(r).alias(f"sd_{m}"), F.avg(F.abs(r)).alias(f"mae_{m}")]
    stats = wide.where(F.col("split") == "val").agg(*exprs)
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def blend_weights(stats: Column, models: Sequence[str]) -> dict[str, Column]:
    """Inverse-MAE weights as expressions; models with MAE 0 share all weight."""
    mae = {m: stats[f"mae_{m}"] for m in models}
    inv = {m: F.lit(1.0) / mae[m] for m in models}
    total = None
    perfect = None
    for m in models:
        total = inv[m] if total is None else total + inv[m]
        hit = (mae[m] == 0).cast("double")
        perfect = hit if perfect is None else perfect + hit
    return {
        m: F.when(perfect > 0, F.when(mae[m] == 0, F.lit(1.0) / perfect).otherwise(F.lit(0.0))).otherwise(inv[m] / total)
        for m in models
    }


def prediction_frame(
    wide: DataFrame, models: Sequence[str], *, confidence: float = 0.90, ensemble: bool = True,
) -> DataFrame:
    """Residual-std intervals ``pred -+ z * sd_val`` (none when sd is 0) and an
    inverse-validation-MAE blend of points and bounds, in one lazy query."""
    # project the scalar subquery once; later expressions read its fields
    wide = wide.withColumn("_stats", validation_scalars(wide, models))
    stats = F.col("_stats")
    z = F.lit(z_value(confidence))
    bounds = {}
    for m in models:
        sd = stats[f"sd_{m}"]
        half = F.when(sd > 0, z * sd).otherwise(F.lit(0.0))
        bounds[f"lo_{m}"] = F.col(f"pred_{m}") - half
        bounds[f"hi_{m}"] = F.col(f"pred_{m}") + half
    out = wide.withColumns(bounds)
    names = list(models)
    if ensemble and len(models) > 1:
        w = blend_weights(stats, models)

        def blend(kind: str):
            total = None
            for m in models:
                term = F.col(f"{kind}_{m}") * w[m]
                total = term if total is None else total + term
            return total

        out = out.withColumns({f"{k}_{ENSEMBLE}": blend(k) for k in ("pred", "lo", "hi")})
        names.append(ENSEMBLE)
    return stack(out.drop("_stats"), names, with_bounds=True)


def ensemble_weights(wide: DataFrame, models: Sequence[str]) -> dict[str, float]:
    stats = validation_stats(wide, models)
    return inverse_mae_weights({m: stats[m][1] for m in models})


def baseline_frame(features: DataFrame, cfg: SplitConfig, *, confidence: float = 0.90) -> DataFrame:
    wide = wide_predictions(features, cfg, BASELINES)
    return prediction_frame(wide, list(BASELINES), confidence=confidence)
