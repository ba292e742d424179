"""Training job: split, fit, score every row, evaluate, blend.

The feature matrix should be persisted (or checkpointed) by the caller:
every fit re-reads only the train/val rows. The trials of both boosted
models grow in one call, then the quantile models of both winners in a
second one. Scoring is one pass per model over the whole matrix; evaluation of all models and
splits is a single grouped aggregate of the long prediction frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.ml import trees
from panelcast.ml.blend import BlendModel
from panelcast.ml.cv import forecaster
from panelcast.ml.linear import fit_ridge, with_val_std
from panelcast.ml.model import FittedModel
from panelcast.operators.evaluation import inverse_mae_weights, metric_exprs
from panelcast.operators.forecasts import ENSEMBLE, stack
from panelcast.operators.splits import SplitConfig, split_label, split_rows

KNOWN_MODELS = ("ridge", "gbt", "gbt_es")
BOOSTED = ("gbt", "gbt_es")


@dataclass
class TrainingResult:
    models: dict[str, FittedModel]
    weights: dict[str, float]
    frame: DataFrame           # long: model, split, entity, period, y, pred, lo, hi
    metrics: DataFrame         # model x split metrics
    coverage: DataFrame        # model -> validation interval coverage


def fit_models(
    features: DataFrame, cfg: SplitConfig, cols: Sequence[str], models: Sequence[str] = KNOWN_MODELS, *,
    target: str = "target", n_trials: int = trees.N_TRIALS, level_space: dict = trees.LEVEL_SPACE,
    leaf_space: dict = trees.LEAF_SPACE, seed: int = 42, patience: int = trees.PATIENCE, confidence: float = 0.90,
    tree_intervals: str = "quantile",
) -> dict[str, FittedModel]:
    """Fit the requested models: ridge, the boosted ones (searched together), and any other name known to
    ``cv.FORECASTERS``. Boosted trees get quantile interval
    models (``tree_intervals='quantile'``, with all of the winner's settings) or
    split-conformal bounds (``'conformal'``)."""
    train, val = split_rows(features, "train", cfg), split_rows(features, "val", cfg)
    makers = {m: forecaster(m, cols, target=target) for m in models if m not in KNOWN_MODELS}
    settings = {"gbt": lambda: trees.level_settings(n_trials, seed, level_space),
                "gbt_es": lambda: trees.leaf_settings(n_trials, seed, leaf_space, patience)}
    boosted = {}
    if any(m in BOOSTED for m in models):
        boosted = trees.search(train, val, cols, {m: settings[m]() for m in models if m in BOOSTED}, target)
        for m in boosted.values():
            trees.calibrate(m, val, target, confidence)
        if tree_intervals == "quantile":
            trees.fit_bounds(train, list(boosted.values()), target, confidence=confidence)
    fitted: dict[str, FittedModel] = {}
    for name in models:
        if name == "ridge":
            fitted[name] = with_val_std(fit_ridge(train, cols, target), val, target)
        else:
            fitted[name] = boosted[name] if name in boosted else makers[name].fit(train, val)
    return fitted


def wide_scores(
    features: DataFrame, cfg: SplitConfig, fitted: dict[str, FittedModel], *,
    target: str = "target", confidence: float = 0.90,
) -> DataFrame:
    """(entity, period, split, y, pred_m, lo_m, hi_m ...) for every fitted model."""
    df = features
    for name, m in fitted.items():
        df = m.with_interval(df, f"pred_{name}", f"lo_{name}", f"hi_{name}", confidence)
    keep = [c for name in fitted for c in (f"pred_{name}", f"lo_{name}", f"hi_{name}")]
    return df.select("entity", "period", split_label(cfg).alias("split"), F.col(target).alias("y"), *keep)


def add_ensemble(wide: DataFrame, members: Sequence[str]) -> tuple[DataFrame, dict[str, float]]:
    """Inverse validation-MAE blend of points and bounds (weights from one aggregate)."""
    row = wide.where(F.col("split") == "val").agg(
        *[F.avg(F.abs(F.col("y") - F.col(f"pred_{m}"))).alias(m) for m in members]
    ).first()
    w = inverse_mae_weights({m: float(row[m]) for m in members})

    def blend(kind: str):
        total = None
        for m in members:
            t = F.col(f"{kind}_{m}") * F.lit(w[m])
            total = t if total is None else total + t
        return total

    return wide.withColumns({f"{k}_{ENSEMBLE}": blend(k) for k in ("pred", "lo", "hi")}), w


def train_and_evaluate(
    features: DataFrame, cfg: SplitConfig, cols: Sequence[str], models: Sequence[str] = KNOWN_MODELS, *,
    ensemble: bool = True, confidence: float = 0.90, registry_root: str | None = None, version: str = "1",
    **fit_kw,
) -> TrainingResult:
    """Fit, score all rows, evaluate every (model, split) in one aggregate,
    measure validation coverage, blend the two boosted models, and (with
    ``registry_root``) save every fitted model and the blend with their metrics and coverage."""
    fitted = fit_models(features, cfg, cols, models, confidence=confidence, **fit_kw)
    wide = wide_scores(features, cfg, fitted, confidence=confidence)
    names = list(fitted)
    weights: dict[str, float] = {}
    members = [m for m in BOOSTED if m in fitted]
    if ensemble and len(members) == 2:
        wide, weights = add_ensemble(wide, members)
        names.append(ENSEMBLE)
    frame = stack(wide, names, with_bounds=True)
    metrics = frame.groupBy("model", "split").agg(*metric_exprs())
    coverage = frame.where(F.col("split") == "val").groupBy("model").agg(
        F.avg(((F.col("y") >= F.col("lo")) & (F.col("y") <= F.col("hi"))).cast("double")).alias("coverage"),
        F.count(F.lit(1)).alias("n"))
    if registry_root:
        from panelcast.ml import registry as reg

        by_model: dict[str, dict[str, dict[str, float]]] = {}
        for r in metrics.collect():  # models x splits rows
            by_model.setdefault(r.model, {})[r.split] = {
                k: float(r[k]) for k in ("mae", "rmse", "r2", "directional_accuracy") if r[k] is not None}
        cov = {r.model: r.coverage for r in coverage.collect()}
        if weights:
            fitted = {**fitted, ENSEMBLE: BlendModel([fitted[m] for m in members], [weights[m] for m in members])}
        for name, model in fitted.items():
            reg.save(features.sparkSession, registry_root, model, version, by_model.get(name, {}), cov.get(name))
    return TrainingResult(fitted, weights, frame, metrics, coverage)
