"""Forecast metrics as single grouped aggregates.

All metrics of a group come from one ``agg`` (map-side partial, one
shuffle on the group key); the group key is small (model x split x ...).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("mae", "rmse", "r2", "mape", "directional_accuracy", "n_samples")


def metric_map(y: str = "y", pred: str = "pred") -> dict[str, Column]:
    """mae, rmse, r2 (0 when y is constant), mape over y != 0 (NULL if none),
    directional accuracy (sign equality, zeros included) and n."""
    yc, pc = F.col(y), F.col(pred)
    resid = yc - pc
    ss_res = F.sum(resid * resid)
    ss_tot = F.var_pop(yc) * F.count(yc)
    return {
        "mae": F.avg(F.abs(resid)),
        "rmse": F.sqrt(F.avg(resid * resid)),
        "r2": F.when(ss_tot > 0, F.lit(1.0) - ss_res / ss_tot).otherwise(F.lit(0.0)),
        "mape": F.avg(F.when(yc != 0, F.abs(resid / yc))) * 100,
        "directional_accuracy": F.avg((F.signum(pc) == F.signum(yc)).cast("double")),
        "n_samples": F.count(F.lit(1)),
    }


def metric_exprs(y: str = "y", pred: str = "pred", names: Sequence[str] = METRICS) -> list[Column]:
    m = metric_map(y, pred)
    return [m[n].alias(n) for n in names]


def evaluate(df: DataFrame, by: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(*by).agg(*metric_exprs(y, pred))


def compare_models(preds: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """model x split pivot of mae, rmse, r2, directional accuracy."""
    resid = F.col("y") - F.col("pred")
    yc = F.col("y")
    ss_tot = F.var_pop(yc) * F.count(yc)
    return preds.groupBy("model").pivot("split", list(splits)).agg(
        F.avg(F.abs(resid)).alias("mae"),
        F.sqrt(F.avg(resid * resid)).alias("rmse"),
        F.when(ss_tot > 0, F.lit(1.0) - F.sum(resid * resid) / ss_tot).otherwise(F.lit(0.0)).alias("r2"),
        F.avg((F.signum("pred") == F.signum("y")).cast("double")).alias("directional_accuracy"),
    )


def inside(y: str = "y", lo: str = "lo", hi: str = "hi") -> Column:
    return ((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double")


def calibration_coverage(df: DataFrame, by: Sequence[str] = (), y: str = "y", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Share of actuals inside the closed interval [lo, hi]."""
    return df.groupBy(*by).agg(F.avg(inside(y, lo, hi)).alias("coverage"), F.count(F.lit(1)).alias("n"))


def z_value(confidence: float = 0.90) -> float:
    """Two-sided normal quantile, e.g. 1.6448536... for 90 %."""
    return NormalDist().inv_cdf((1 + confidence) / 2)


def inverse_mae_weights(maes: dict[str, float]) -> dict[str, float]:
    """w_m proportional to 1 / MAE_m; a model with MAE 0 takes all weight."""
    perfect = [m for m, v in maes.items() if v == 0]
    if perfect:
        return {m: (1.0 / len(perfect) if m in perfect else 0.0) for m in maes}
    inv = {m: 1.0 / v for m, v in maes.items()}
    total = sum(inv.values())
    return {m: v / total for m, v in inv.items()}
