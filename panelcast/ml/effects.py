"""Ridge with one effect per entity, for any number of entities.

The model is the ridge on standardised features and standardised one-hot columns, but no row ever has a
column per entity. With ``n_e, x_e, y_e`` the rows and sums of entity e, and ``s_e`` the deviation
of its one-hot column, the penalised effect of e given the other coefficients is

    effect_e = (y_e - b n_e - w . x_e) / (n_e + alpha s_e^2)

Put back into the normal equations this takes ``g_e g_e^T / (n_e + alpha s_e^2)`` off the moment matrix for every
entity (``g_e = [n_e, x_e, y_e]``), which is one more sum of products over a row per entity. The driver solves
(d + 1) x (d + 1) equations; effects stay a table, joined to the rows that are scored. All alphas
are tried in the same passes and judged by the validation rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.ml.linear import ALPHAS, standardisation
from panelcast.ml.model import FittedModel, model_kind
from panelcast.ml.moments import gram_by_group
from panelcast.operators.evaluation import z_value
from panelcast.session import stored


@model_kind("ridge-effects")
@dataclass
class EffectRidge(FittedModel):
    feature_cols: list[str]
    mean: list[float]
    scale: list[float]
    coef: list[float]
    intercept: float
    alpha: float
    effects: DataFrame                  # entity, effect
    entity: str = "entity"
    effect_std: float = 0.0
    val_rmse: dict[str, float] = field(default_factory=dict)
    val_residual_std: float = 0.0
    name: str = "ridge_effects"

    def _terms(self) -> list[Column]:
        return [F.lit(w) * (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s, w in zip(
            self.feature_cols, self.mean, self.scale, self.coef, strict=True)]

    def _with_effect(self, df: DataFrame, out: str) -> DataFrame:
        """The effect of each row's entity; 0 for one that was not seen in training."""
        effects = self.effects.select(F.col("entity").alias("_entity"), F.col("effect").alias(out))
        joined = df.join(effects, F.col(self.entity) == F.col("_entity"), "left").drop("_entity")
        return joined.withColumn(out, F.coalesce(out, F.lit(0.0)))

    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return self._with_effect(df, "_effect").withColumn(
            out, sum(self._terms(), F.lit(self.intercept)) + F.col("_effect")).drop("_effect")

    def with_interval(self, df: DataFrame, pred: str = "pred", lo: str = "lo", hi: str = "hi",
                      confidence: float = 0.90) -> DataFrame:
        half = F.lit(z_value(confidence) * self.val_residual_std)
        return self.transform(df, pred).withColumns({lo: F.col(pred) - half, hi: F.col(pred) + half})

    def importance(self) -> list[tuple[str, float]]:
        """Coefficients of the standardised features, and the deviation of the effects over the training rows."""
        pairs = [(c, abs(w)) for c, w in zip(self.feature_cols, self.coef, strict=True)]
        return sorted([*pairs, (self.entity, self.effect_std)], key=lambda t: (-t[1], t[0]))

    def attributions(self, df: DataFrame, values: str = "shap_values", base: str = "base_value") -> DataFrame:
        keys = F.array(*[F.lit(c) for c in (*self.feature_cols, self.entity)])
        return self._with_effect(df, "_effect").withColumns({
            values: F.map_from_arrays(keys, F.array(*self._terms(), F.col("_effect"))),
            base: F.lit(self.intercept)}).drop("_effect")

    def parts(self, spark: SparkSession) -> tuple[dict, dict[str, DataFrame]]:
        info = {k: getattr(self, k) for k in ("mean", "scale", "coef", "intercept", "alpha", "entity", "effect_std",
                                              "val_rmse", "val_residual_std")}
        return info, {"effects": self.effects}

    @classmethod
    def from_parts(cls, name: str, feature_cols: list[str], info: dict, table: Callable[[str], DataFrame],
                   members: list[FittedModel]) -> EffectRidge:
        return cls(feature_cols=list(feature_cols), effects=table("effects"), name=name, **info)


def _sums(z: DataFrame, zcols: list[str], entity: str, target: str) -> DataFrame:
    """Rows and sums per entity; rows without an entity have no effect."""
    return z.where(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("entity")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(c).alias(c) for c in zcols], F.sum(target).alias("y"))


def fit_effect_ridge(train: DataFrame, val: DataFrame, feature_cols: Sequence[str], target: str = "target", *,
                     alphas: Sequence[float] = ALPHAS, entity: str = "entity", name: str = "ridge_effects") -> EffectRidge:
    """The ridge of the alpha with the least validation RMSE (the first of equals; without validation rows the first)."""
    cols = list(feature_cols)
    mean, scale, n_rows = standardisation(train, cols)
    zcols = [f"z{j}" for j in range(len(cols))]

    def standardised(rows: DataFrame) -> DataFrame:
        return rows.select(entity, F.col(target).alias("y"), *[
            ((F.col(c) - F.lit(mean[j])) / F.lit(scale[j])).alias(zcols[j]) for j, c in enumerate(cols)])

    z, z_val = standardised(train), standardised(val)
    share = F.col("n") / F.lit(float(n_rows))
    square = F.when(share < 1, share * (1 - share)).otherwise(F.lit(1.0))  # a constant column counts as one of deviation 1
    sums = stored(_sums(z, zcols, entity, "y").withColumn("s2", square), "entity-sums")
    moments = gram_by_group(z, zcols, "y")[0]
    each = sums.withColumn("at", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), (1 / F.sqrt(F.col("n") + F.lit(float(a)) * F.col("s2"))).alias("u"))
        for i, a in enumerate(alphas)])))
    weighted = each.select(F.col("at.i").alias("i"), *[(F.col(c) * F.col("at.u")).alias(c) for c in ("n", *zcols, "y")])
    taken = gram_by_group(weighted, ["n", *zcols], "y", "i")
    solved = []
    for i, a in enumerate(alphas):
        reduced = moments - (taken[i][1:, 1:] if i in taken else 0.0)
        penalty = np.diag([0.0, *[float(a)] * len(cols)])
        solution = np.linalg.solve(reduced[:-1, :-1] + penalty, reduced[:-1, -1])
        solved.append((float(solution[0]), [float(w) for w in solution[1:]]))

    def effect(i: int) -> Column:
        b, w = solved[i]
        rest = F.col("y") - F.lit(b) * F.col("n")
        for c, x in zip(zcols, w, strict=True):
            rest = rest - F.lit(x) * F.col(c)
        return rest / (F.col("n") + F.lit(float(alphas[i])) * F.col("s2"))

    # squared validation errors from sums: v'Gv - 2 effect (g v) + n effect^2, v = [-b, -w, 1]
    val_moments = gram_by_group(z_val, zcols, "y").get(0)
    rmse: dict[str, float] = {}
    best = 0
    if val_moments is not None:
        own = sums.withColumns({f"e{i}": effect(i) for i in range(len(alphas))})
        seen = _sums(z_val, zcols, entity, "y").join(own.select("entity", *[f"e{i}" for i in range(len(alphas))]), "entity")

        def shift(i: int) -> Column:
            b, w = solved[i]
            along = F.col("y") - F.lit(b) * F.col("n")
            for c, x in zip(zcols, w, strict=True):
                along = along - F.lit(x) * F.col(c)
            return F.sum(F.col("n") * F.col(f"e{i}") ** 2 - 2 * F.col(f"e{i}") * along)

        row = seen.agg(*[shift(i).alias(f"s{i}") for i in range(len(alphas))]).first()
        for i, a in enumerate(alphas):
            v = np.array([-solved[i][0], *[-x for x in solved[i][1]], 1.0])
            error = float(v @ val_moments @ v) + float(row[f"s{i}"] or 0.0)
            rmse[str(a)] = float(np.sqrt(max(0.0, error) / val_moments[0, 0]))
        best = min(range(len(alphas)), key=lambda i: (rmse[str(alphas[i])], i))
    effects = stored(sums.select("entity", effect(best).alias("effect"), "n"), "entity-effects")
    spread = effects.agg((F.sum(F.col("n") * F.col("effect") ** 2) / n_rows
                          - (F.sum(F.col("n") * F.col("effect")) / n_rows) ** 2).alias("v")).first()["v"]
    model = EffectRidge(cols, mean, scale, solved[best][1], solved[best][0], float(alphas[best]),
                        effects.select("entity", "effect"), entity, float(np.sqrt(max(0.0, spread or 0.0))), rmse, name=name)
    sd = model.transform(val, "pred").agg(F.stddev_pop(F.col(target) - F.col("pred"))).first()[0]
    model.val_residual_std = float(sd or 0.0)
    return model
