"""Pluggable forecasters and walk-forward cross-validation.

A forecaster factory takes the feature columns and returns an object with
``fit(train, val) -> FittedModel``. ``FORECASTERS`` maps model names to
factories (unknown names raise); ``register_forecaster`` adds one. A forecaster may also have
``fit_folds(features, folds) -> models``, which fits all folds at once: ridges from moments
that are summed once, boosted trees in one call. Others are fitted fold by fold (at
most ``n_splits``, a driver loop over a bounded plan). Validation metrics of all folds
are one DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.ml import trees
from panelcast.ml.boosting import Setting, grow
from panelcast.ml.linear import fit_ridge, fit_ridge_folds
from panelcast.ml.model import FittedModel
from panelcast.operators.evaluation import metric_exprs
from panelcast.operators.splits import Fold, SplitConfig, distinct_periods_list, plan_folds, split_rows


@dataclass
class RidgeForecaster:
    cols: list[str]
    target: str = "target"

    def fit(self, train: DataFrame, val: DataFrame) -> FittedModel:
        return fit_ridge(train, self.cols, self.target)

    def fit_folds(self, features: DataFrame, folds: Sequence[Fold], period: str = "period") -> list[FittedModel]:
        return fit_ridge_folds(features, self.cols, folds, self.target, period=period)


@dataclass
class BoostedForecaster:
    """The best of ``settings`` by validation RMSE (one setting: no search)."""

    cols: list[str]
    name: str
    settings: list[Setting]
    target: str = "target"

    def fit(self, train: DataFrame, val: DataFrame) -> FittedModel:
        return trees.search(train, val, self.cols, {self.name: self.settings}, self.target)[self.name]

    def fit_folds(self, features: DataFrame, folds: Sequence[Fold], period: str = "period") -> list[FittedModel]:
        learners = [replace(s, train_to=f.train_end, val_to=f.val_end) for f in folds for s in self.settings]
        grown = grow(features, self.cols, learners, self.target, period)
        out, n = [], len(self.settings)
        for i in range(len(folds)):
            mine = list(zip(grown[i * n : (i + 1) * n], learners[i * n : (i + 1) * n], strict=True))
            best, setting = min(mine, key=lambda m: m[0].val_rmse[m[0].best_round])
            out.append(trees.tree_model(self.name, self.cols, best, setting, n))
        return out


FORECASTERS: dict[str, Callable[..., object]] = {
    "ridge": lambda cols, target="target": RidgeForecaster(list(cols), target),
    "gbt": lambda cols, target="target", settings=None: BoostedForecaster(
        list(cols), "gbt", settings or trees.level_settings(), target),
    "gbt_es": lambda cols, target="target", settings=None: BoostedForecaster(
        list(cols), "gbt_es", settings or [trees.DEFAULT_LEAF], target),
}


def register_forecaster(name: str, factory: Callable[..., object]) -> None:
    """Make a forecaster known to training and cross-validation."""
    FORECASTERS[name] = factory


def forecaster(name: str, cols: Sequence[str], **kw):
    if name not in FORECASTERS:
        raise ValueError(f"unknown model {name!r}; expected one of {sorted(FORECASTERS)}")
    return FORECASTERS[name](cols, **kw)


def walk_forward_cv(
    features: DataFrame, cols: Sequence[str], model: str = "ridge", *, n_splits: int = 5,
    min_train: int = 24, val: int = 8, target: str = "target", **model_kw,
) -> DataFrame:
    """(fold, model, mae, rmse, r2, mape, directional_accuracy, n_samples) per fold.

    The plan's periods come from the rows, so each fold has training and
    validation rows."""
    folds = plan_folds(distinct_periods_list(features), n_splits, min_train, val)
    fc = forecaster(model, cols, target=target, **model_kw)
    splits = [(split_rows(features, "train", cfg), split_rows(features, "val", cfg))
              for cfg in (SplitConfig(f.train_end, f.val_end) for f in folds)]
    fitted = fc.fit_folds(features, folds) if hasattr(fc, "fit_folds") else [fc.fit(*s) for s in splits]
    out = None
    for f, m, (_, rows) in zip(folds, fitted, splits, strict=True):
        scored = m.transform(rows, "pred").select(F.col(target).alias("y"), "pred")
        part = scored.agg(*metric_exprs()).select(F.lit(f.fold).alias("fold"), F.lit(model).alias("model"), "*")
        out = part if out is None else out.unionByName(part)
    return out
