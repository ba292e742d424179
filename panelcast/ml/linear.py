"""Ridge regression on standardised features, chosen by contiguous K-fold CV.

Fit: feature means and population stds come from one aggregate over the
training rows (zero variance -> scale 1); K-fold moment matrices come from
:func:`panelcast.ml.moments.gram_by_group`, summed in the JVM. For every alpha and held-out
fold the centred normal equations of the other folds are solved on the
driver (d x d) and the held-out R^2 is evaluated from the held-out moments,
so CV never re-reads the data. The best mean R^2 (first on ties) picks
alpha; the final solve uses all training moments.

Scoring is a linear column expression on the raw features (the scaler is
folded into the coefficients): no vector assembly, no Python on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.ml.model import FittedModel, model_kind
from panelcast.ml.moments import gram_by_group, moments_by_period, pooled, restandardised
from panelcast.operators.evaluation import z_value
from panelcast.operators.offsets import entity_offsets
from panelcast.operators.splits import Fold

# Regularisation grid and number of CV folds.
ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
N_FOLDS = 5


@model_kind("ridge")
@dataclass
class RidgeModel(FittedModel):
    feature_cols: list[str]
    mean: list[float]
    scale: list[float]
    coef: list[float]            # on standardised features
    intercept: float
    alpha: float
    cv_r2: dict[str, float] = field(default_factory=dict)
    val_residual_std: float = 0.0
    name: str = "ridge"

    # -- scoring -----------------------------------------------------------
    def z(self, j: int) -> Column:
        return (F.col(self.feature_cols[j]) - F.lit(self.mean[j])) / F.lit(self.scale[j])

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for j in range(len(self.feature_cols)):
            if self.coef[j] != 0.0:
                out = out + F.lit(self.coef[j]) * self.z(j)
        return out

    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return df.withColumn(out, self.prediction())

    def interval(self, z_value: float) -> tuple[Column, Column, Column]:
        p = self.prediction()
        half = z_value * self.val_residual_std if self.val_residual_std > 0 else 0.0
        return p, p - F.lit(half), p + F.lit(half)

    # -- explanation -------------------------------------------------------
    def importance(self) -> list[tuple[str, float]]:
        pairs = [(c, abs(w)) for c, w in zip(self.feature_cols, self.coef)]
        return sorted(pairs, key=lambda t: (-t[1], t[0]))

    def with_interval(self, df: DataFrame, pred: str = "pred", lo: str = "lo", hi: str = "hi",
                      confidence: float = 0.90) -> DataFrame:
        p, low, high = self.interval(z_value(confidence))
        return df.withColumns({pred: p, lo: low, hi: high})

    def attributions(self, df: DataFrame, values: str = "shap_values", base: str = "base_value") -> DataFrame:
        contrib, start = self.attribution()
        return df.withColumns({values: contrib, base: start})

    def attribution(self) -> tuple[Column, Column]:
        """Additive contributions ``coef_j * z_j`` (background = training mean,
        where z is 0) as a MAP<STRING, DOUBLE>, and the base value."""
        keys = F.array(*[F.lit(c) for c in self.feature_cols])
        vals = F.array(*[F.lit(self.coef[j]) * self.z(j) for j in range(len(self.feature_cols))])
        return F.map_from_arrays(keys, vals), F.lit(self.intercept)

    # -- persistence -------------------------------------------------------
    def parts(self, spark: SparkSession) -> tuple[dict, dict[str, DataFrame]]:
        return asdict(self), {}

    @classmethod
    def from_parts(cls, name: str, feature_cols: list[str], info: dict, table: Callable[[str], DataFrame],
                   members: list[FittedModel]) -> RidgeModel:
        return cls(**info)


def standardisation(df: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float], int]:
    """Means, population stds (zero/undefined -> 1) and the row count, in one aggregate."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
                 F.count(F.lit(1)).alias("n")).first()
    mean = [float(row[f"m{i}"]) for i in range(len(cols))]
    scale = [float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(cols))]
    return mean, scale, int(row["n"])


def _fold_of(index: Column, total: int, n_folds: int) -> Column:
    """Contiguous block of a row's index: the first ``total % n_folds`` blocks are one row larger."""
    sizes = [total // n_folds + (1 if k < total % n_folds else 0) for k in range(n_folds)]
    bounds = np.cumsum(sizes).tolist()
    fold = F.lit(n_folds - 1)
    for k in reversed(range(n_folds - 1)):
        fold = F.when(index < bounds[k], F.lit(k)).otherwise(fold)
    return fold.cast("int")


def contiguous_folds(
    df: DataFrame, n_folds: int = N_FOLDS, *, entity: str = "entity", period: str = "period",
    total: int | None = None,
) -> DataFrame:
    """``fold`` column: K contiguous blocks of the rows in (entity, period) order,
    sizes as unshuffled K-fold (the first n % K blocks one row larger).

    The global row index is a row number inside each entity plus the entity's offset.
    """
    offsets = entity_offsets(df.groupBy(entity).agg(F.count(F.lit(1)).alias("n")), entity)
    if total is None:
        total = df.count()
    index = F.row_number().over(Window.partitionBy(entity).orderBy(period)) - 1 + F.col("offset_n")
    tagged = df.join(offsets, entity).withColumn("_idx", index)
    return tagged.withColumn("fold", _fold_of(F.col("_idx"), total, n_folds)).drop("_idx", "offset_n")


def _solve(g: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Ridge with intercept from a Gram matrix of [1, z, y]."""
    d = g.shape[0] - 2
    n = g[0, 0]
    sz, sy = g[0, 1:d + 1], g[0, d + 1]
    szz, szy = g[1:d + 1, 1:d + 1], g[1:d + 1, d + 1]
    mz, my = sz / n, sy / n
    a = szz - n * np.outer(mz, mz) + alpha * np.eye(d)
    b = szy - n * mz * my
    w = np.linalg.solve(a, b)
    return w, float(my - mz @ w)


def _r2(g: np.ndarray, w: np.ndarray, b0: float) -> float:
    """Held-out R^2 of y ~ b0 + z.w from the held-out Gram matrix."""
    d = g.shape[0] - 2
    n = g[0, 0]
    sz, sy, syy = g[0, 1:d + 1], g[0, d + 1], g[d + 1, d + 1]
    szz, szy = g[1:d + 1, 1:d + 1], g[1:d + 1, d + 1]
    ss_res = syy - 2 * b0 * sy - 2 * w @ szy + n * b0 * b0 + 2 * b0 * (w @ sz) + w @ szz @ w
    ss_tot = syy - sy * sy / n
    if ss_tot <= 0:
        return 1.0 if ss_res <= 1e-12 else 0.0
    return float(1 - ss_res / ss_tot)


def fit_ridge(
    train: DataFrame, feature_cols: Sequence[str], target: str = "target", *,
    alphas: Sequence[float] = ALPHAS, n_folds: int = N_FOLDS, entity: str = "entity", period: str = "period",
) -> RidgeModel:
    cols = list(feature_cols)
    mean, scale, n_rows = standardisation(train, cols)
    z = train.select(
        entity, period, target,
        *[((F.col(c) - F.lit(mean[j])) / F.lit(scale[j])).alias(f"z{j}") for j, c in enumerate(cols)],
    )
    zcols = [f"z{j}" for j in range(len(cols))]
    grams = gram_by_group(contiguous_folds(z, n_folds, entity=entity, period=period, total=n_rows), zcols, target, "fold")
    return _chosen(cols, mean, scale, grams, alphas)


def _chosen(cols: list[str], mean: list[float], scale: list[float], grams: dict[int, np.ndarray],
            alphas: Sequence[float]) -> RidgeModel:
    """The ridge of the best alpha, from the moments of each inner fold on standardised features."""
    total = sum(grams.values())
    scores = {}
    for a in alphas:
        r2s = []
        for g in grams.values():
            w, b0 = _solve(total - g, a)
            r2s.append(_r2(g, w, b0))
        scores[a] = float(np.mean(r2s))
    best = max(alphas, key=lambda a: (scores[a], -list(alphas).index(a)))
    w, b0 = _solve(total, best)
    return RidgeModel(cols, mean, scale, [float(x) for x in w], b0, float(best),
                      {str(a): s for a, s in scores.items()})


def fit_ridge_folds(
    features: DataFrame, feature_cols: Sequence[str], folds: Sequence[Fold], target: str = "target", *,
    alphas: Sequence[float] = ALPHAS, n_folds: int = N_FOLDS, entity: str = "entity", period: str = "period",
) -> list[RidgeModel]:
    """The ridge of every expanding fold, in as many reads of the features as one fit takes.

    Means and deviations come from moments per period, pooled over each fold's training periods. Rows are
    standardised once, by those of all training rows; a row's index in a fold's training rows is its number inside
    its entity plus the fold's offset of the entity, so its inner block of every fold is known at once, and
    one aggregation sums the moments of all (fold, block). They are then turned to each fold's own standardisation.
    """
    cols = list(feature_cols)
    last = max(f.train_end for f in folds)
    rows = features.where(F.col(period) <= last)
    by_period = moments_by_period(rows, cols, period)

    def standard(end: int) -> tuple[int, np.ndarray, np.ndarray]:
        n, mean, square = pooled([by_period[p] for p in sorted(by_period) if p <= end])
        scale = np.sqrt(square / n)
        return n, mean, np.where(scale > 0, scale, 1.0)

    own = [standard(f.train_end) for f in folds]
    _, mean, scale = standard(last)
    inside = [F.sum((F.col(period) <= f.train_end).cast("long")).alias(f"n{i}") for i, f in enumerate(folds)]
    offsets = entity_offsets(rows.groupBy(entity).agg(*inside), entity)
    number = F.row_number().over(Window.partitionBy(entity).orderBy(period)) - 1
    z = rows.select(entity, period, target, *[
        ((F.col(c) - F.lit(float(mean[j]))) / F.lit(float(scale[j]))).alias(f"z{j}") for j, c in enumerate(cols)])
    tagged = z.withColumn("_rn", number).join(offsets, entity)
    groups = [F.when(F.col(period) <= f.train_end,
                     _fold_of(F.col("_rn") + F.col(f"offset_n{i}"), own[i][0], n_folds) + i * n_folds)
              for i, f in enumerate(folds)]
    each = tagged.withColumn("_group", F.explode(F.array_compact(F.array(*groups))))
    grams = gram_by_group(each, [f"z{j}" for j in range(len(cols))], target, "_group")
    out = []
    for i, (_, own_mean, own_scale) in enumerate(own):
        mine = {k: restandardised(grams[i * n_folds + k], mean, scale, own_mean, own_scale)
                for k in range(n_folds) if i * n_folds + k in grams}
        out.append(_chosen(cols, own_mean.tolist(), own_scale.tolist(), mine, alphas))
    return out


def with_val_std(model: RidgeModel, val: DataFrame, target: str = "target") -> RidgeModel:
    """Population std of validation residuals (the interval width)."""
    r = F.col(target) - model.prediction()
    sd = val.agg(F.stddev_pop(r)).first()[0]
    model.val_residual_std = float(sd) if sd else 0.0
    return model
