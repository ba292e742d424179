"""Boosted trees: searches over sampled settings, early stopping, quantile bounds.

All learners of a call are grown in lock step (``panelcast.ml.boosting``):

* ``level_settings``: the first boosted model, grown level by level; each
  trial runs all its rounds, the best validation RMSE wins.
* ``leaf_settings``: the second one, grown best gain first up to a number of
  leaves; each trial stops after 50 rounds without gain and keeps its best round.
* ``fit_bounds``: lower and upper quantile models with the settings of the
  point models, all in one call.

Settings are drawn up front from a seeded generator and the winner is the
least (RMSE, trial), so the same seed gives the same model.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.ml import treeshap
from panelcast.ml.boosting import Grown, Setting, grow
from panelcast.ml.forest import Forest, scores
from panelcast.ml.model import FittedModel, model_kind

# Search ranges of the boosted-tree models. Ranges of ``LOGARITHMIC`` are drawn on a log scale.
LEVEL_SPACE = {
    "rounds": (100, 800), "depth": (3, 7), "step": (1e-3, 0.3), "row_share": (0.6, 1.0),
    "feature_share": (0.6, 1.0), "least_rows": (1, 10), "l1": (1e-8, 10.0), "l2": (1e-8, 10.0),
}
LEAF_SPACE = {
    "rounds": (100, 1000), "depth": (3, 8), "step": (1e-3, 0.3), "leaves": (15, 127), "row_share": (0.6, 1.0),
    "feature_share": (0.6, 1.0), "least_rows": (5, 50), "l1": (1e-8, 10.0), "l2": (1e-8, 10.0),
}
LOGARITHMIC = ("step", "l1", "l2")
N_TRIALS = 50
PATIENCE = 50
#: the early-stopped model where no search is asked for
DEFAULT_LEAF = Setting(rounds=200, depth=4, step=0.05, patience=PATIENCE)


@model_kind("boosted")
@dataclass
class TreeModel(FittedModel):
    name: str
    feature_cols: list[str]
    forest: Forest
    params: dict = field(default_factory=dict)
    val_rmse: float | None = None
    resid_q_lo: float = 0.0
    resid_q_hi: float = 0.0
    val_residual_std: float = 0.0
    lower: Forest | None = None   # quantile models of the bounds (else conformal)
    upper: Forest | None = None

    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return scores(df, {out: self.forest})

    def with_interval(self, df: DataFrame, pred: str = "pred", lo: str = "lo", hi: str = "hi",
                      confidence: float = 0.90) -> DataFrame:
        """Bounds of the quantile models if they were fitted, else the validation residuals' quantiles around
        the prediction; both hold for the confidence that the model was fitted with."""
        if self.lower is not None and self.upper is not None:
            return scores(df, {pred: self.forest, lo: self.lower, hi: self.upper})
        df = self.transform(df, pred)
        return df.withColumns({lo: F.col(pred) + F.lit(self.resid_q_lo), hi: F.col(pred) + F.lit(self.resid_q_hi)})

    def importance(self) -> list[tuple[str, float]]:
        return self.forest.importance()

    def attributions(self, df: DataFrame, values: str = "shap_values", base: str = "base_value") -> DataFrame:
        return treeshap.attributions(df, self.forest, values, base)

    def parts(self, spark: SparkSession) -> tuple[dict, dict[str, DataFrame]]:
        forests = {"point": self.forest, "lower": self.lower, "upper": self.upper}
        info = {"params": self.params, "val_rmse": self.val_rmse, "resid_q_lo": self.resid_q_lo,
                "resid_q_hi": self.resid_q_hi, "val_residual_std": self.val_residual_std,
                "init": {k: f.init for k, f in forests.items() if f is not None}}
        return info, {k: f.table(spark) for k, f in forests.items() if f is not None}

    @classmethod
    def from_parts(cls, name: str, feature_cols: list[str], info: dict, table: Callable[[str], DataFrame],
                   members: list[FittedModel]) -> TreeModel:
        forests = {k: Forest.from_table(table(k), feature_cols, init) for k, init in info["init"].items()}
        return cls(name, list(feature_cols), forests["point"], info["params"], info["val_rmse"], info["resid_q_lo"],
                   info["resid_q_hi"], info["val_residual_std"], forests.get("lower"), forests.get("upper"))


# -- settings -----------------------------------------------------------------


def sample_setting(rng: random.Random, space: dict, **fixed) -> Setting:
    drawn = {}
    for name, (low, high) in space.items():
        if name in LOGARITHMIC:
            drawn[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            drawn[name] = rng.randint(low, high) if isinstance(low, int) else rng.uniform(low, high)
    return Setting(**drawn, **fixed)


def level_settings(n_trials: int = N_TRIALS, seed: int = 42, space: dict = LEVEL_SPACE) -> list[Setting]:
    rng = random.Random(seed)
    return [sample_setting(rng, space, seed=seed) for _ in range(n_trials)]


def leaf_settings(n_trials: int = N_TRIALS, seed: int = 42, space: dict = LEAF_SPACE,
                  patience: int = PATIENCE) -> list[Setting]:
    rng = random.Random(seed)
    return [sample_setting(rng, space, seed=seed, patience=patience) for _ in range(n_trials)]


# -- fits ---------------------------------------------------------------------


def staged(train: DataFrame, val: DataFrame | None, cols: Sequence[str], target: str) -> DataFrame:
    """Training rows (stage 0) and validation rows (stage 1) as one frame."""
    rows = train.select(*cols, target, F.lit(0).alias("stage"))
    if val is None:
        return rows
    return rows.unionByName(val.select(*cols, target, F.lit(1).alias("stage")))


def tree_model(name: str, cols: Sequence[str], grown: Grown, setting: Setting, trials: int = 1) -> TreeModel:
    params = {**asdict(setting), "trees": grown.forest.n_trees, "trials": trials}
    return TreeModel(name, list(cols), grown.forest, params, grown.val_rmse[grown.best_round])


def search(train: DataFrame, val: DataFrame, cols: Sequence[str], searches: dict[str, list[Setting]],
           target: str = "target") -> dict[str, TreeModel]:
    """The best trial of each search by (validation RMSE, trial); all trials of all searches grow in one call."""
    trials = [(name, s) for name, settings in searches.items() for s in settings]
    grown = grow(staged(train, val, cols, target), cols, [s for _, s in trials], target)
    out = {}
    for name, settings in searches.items():
        mine = [(g.val_rmse[g.best_round], i, g, s) for i, ((n, s), g) in enumerate(zip(trials, grown, strict=True))
                if n == name]
        _, _, best, setting = min(mine, key=lambda m: m[:2])
        out[name] = tree_model(name, cols, best, setting, len(settings))
    return out


def search_gbt(train: DataFrame, val: DataFrame, cols: Sequence[str], target: str = "target", *,
               n_trials: int = N_TRIALS, seed: int = 42, space: dict = LEVEL_SPACE, name: str = "gbt") -> TreeModel:
    """Best of ``n_trials`` sampled settings, grown level by level."""
    return search(train, val, cols, {name: level_settings(n_trials, seed, space)}, target)[name]


def search_gbt_early_stopping(train: DataFrame, val: DataFrame, cols: Sequence[str], target: str = "target", *,
                              n_trials: int = N_TRIALS, seed: int = 42, space: dict = LEAF_SPACE,
                              patience: int = PATIENCE, name: str = "gbt_es") -> TreeModel:
    """Best of ``n_trials`` sampled settings, grown leaf first and stopped early."""
    return search(train, val, cols, {name: leaf_settings(n_trials, seed, space, patience)}, target)[name]


def fit_gbt_early_stopping(train: DataFrame, val: DataFrame, cols: Sequence[str], target: str = "target", *,
                           setting: Setting = DEFAULT_LEAF, name: str = "gbt_es") -> TreeModel:
    """One early-stopped setting without a search."""
    return search(train, val, cols, {name: [setting]}, target)[name]


def fit_quantiles(train: DataFrame, cols: Sequence[str], settings: Sequence[Setting],
                  target: str = "target") -> list[Forest]:
    """Forests for settings with a quantile loss, grown together."""
    return [g.forest for g in grow(staged(train, None, cols, target), cols, settings, target)]


def fit_bounds(train: DataFrame, models: Sequence[TreeModel], target: str = "target", *,
               confidence: float = 0.90) -> None:
    """Give each model its lower and upper quantile forests: ((1-c)/2, (1+c)/2), with all of its tuned settings
    and all its rounds."""
    keep = ("rounds", "step", "depth", "leaves", "least_rows", "row_share", "feature_share", "l1", "l2", "seed")
    tuned = [Setting(**{k: m.params[k] for k in keep}) for m in models]
    settings = [replace(s, quantile=q) for s in tuned for q in ((1 - confidence) / 2, (1 + confidence) / 2)]
    forests = fit_quantiles(train, models[0].feature_cols, settings, target) if models else []
    for i, m in enumerate(models):
        m.lower, m.upper = forests[2 * i], forests[2 * i + 1]


def calibrate(model: TreeModel, val: DataFrame, target: str = "target", confidence: float = 0.90) -> TreeModel:
    """Residual quantiles ((1-c)/2, (1+c)/2) and population std on validation rows."""
    r = F.col(target) - F.col("pred")
    qs = [(1 - confidence) / 2, (1 + confidence) / 2]
    row = model.transform(val, "pred").agg(
        F.percentile_approx(r, qs, 100000).alias("q"), F.stddev_pop(r).alias("sd")).first()
    if row.q is not None:
        model.resid_q_lo, model.resid_q_hi = float(row.q[0]), float(row.q[1])
    model.val_residual_std = float(row.sd or 0.0)
    return model
