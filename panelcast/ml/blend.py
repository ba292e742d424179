"""The inverse-MAE blend as a model of its own: fit, score, bounds, importance, attribution."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.ml.model import FittedModel, model_kind
from panelcast.operators.evaluation import inverse_mae_weights
from panelcast.operators.forecasts import ENSEMBLE

MEMBER = "_member{}"


def _weighted(columns: list[str], weights: list[float]):
    total = F.lit(0.0)
    for c, w in zip(columns, weights, strict=True):
        total = total + F.col(c) * F.lit(w)
    return total


@model_kind("blend")
@dataclass
class BlendModel(FittedModel):
    members: list[FittedModel]
    weights: list[float]
    name: str = ENSEMBLE
    feature_cols: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.feature_cols = list(self.members[0].feature_cols)
        if any(list(m.feature_cols) != self.feature_cols for m in self.members):
            raise ValueError("members of a blend need the same features")

    @classmethod
    def fit(cls, members: list[FittedModel], val: DataFrame, target: str = "target") -> BlendModel:
        """Weights from the members' validation MAE, in one aggregate."""
        scored = val
        for i, m in enumerate(members):
            scored = m.transform(scored, MEMBER.format(i))
        row = scored.agg(*[F.avg(F.abs(F.col(target) - F.col(MEMBER.format(i)))).alias(str(i))
                           for i in range(len(members))]).first()
        found = inverse_mae_weights({str(i): float(row[i]) for i in range(len(members))})
        return cls(members, [found[str(i)] for i in range(len(members))])

    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        names = [MEMBER.format(i) for i in range(len(self.members))]
        for m, name in zip(self.members, names, strict=True):
            df = m.transform(df, name)
        return df.withColumn(out, _weighted(names, self.weights)).drop(*names)

    def with_interval(self, df: DataFrame, pred: str = "pred", lo: str = "lo", hi: str = "hi",
                      confidence: float = 0.90) -> DataFrame:
        names = [[f"_{k}{i}" for i in range(len(self.members))] for k in ("pred", "lo", "hi")]
        for m, own in zip(self.members, zip(*names, strict=True), strict=True):
            df = m.with_interval(df, *own, confidence=confidence)
        blended = {out: _weighted(own, self.weights) for out, own in zip((pred, lo, hi), names, strict=True)}
        return df.withColumns(blended).drop(*sum(names, []))

    def importance(self) -> list[tuple[str, float]]:
        """Weighted mean of the members' importances, each scaled to add up to 1."""
        total = dict.fromkeys(self.feature_cols, 0.0)
        for m, w in zip(self.members, self.weights, strict=True):
            pairs = m.importance()
            whole = sum(v for _, v in pairs) or 1.0
            for c, v in pairs:
                total[c] += w * v / whole
        return sorted(total.items(), key=lambda t: (-t[1], t[0]))

    def attributions(self, df: DataFrame, values: str = "shap_values", base: str = "base_value") -> DataFrame:
        """The members' attributions, each added to the same row, weighted and summed."""
        for i, m in enumerate(self.members):
            df = m.attributions(df, f"_values{i}", f"_base{i}")
        bases = [f"_base{i}" for i in range(len(self.members))]
        keys = F.array(*[F.lit(c) for c in self.feature_cols])
        sums = [sum((F.col(f"_values{i}")[c] * F.lit(w) for i, w in enumerate(self.weights)), F.lit(0.0))
                for c in self.feature_cols]
        out = df.withColumns({values: F.map_from_arrays(keys, F.array(*sums)), base: _weighted(bases, self.weights)})
        return out.drop(*bases, *(f"_values{i}" for i in range(len(self.members))))

    def member_models(self) -> list[FittedModel]:
        return list(self.members)

    def parts(self, spark: SparkSession) -> tuple[dict, dict[str, DataFrame]]:
        return {"weights": self.weights}, {}

    @classmethod
    def from_parts(cls, name: str, feature_cols: list[str], info: dict, table: Callable[[str], DataFrame],
                   members: list[FittedModel]) -> BlendModel:
        return cls(members, info["weights"], name)
