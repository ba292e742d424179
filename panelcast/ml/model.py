"""One protocol for all fitted models.

A fitted model adds columns to rows: a prediction, an interval, additive
attributions. It ranks its features and gives itself away as parts (numbers as JSON, tables as
DataFrames) from which the registry makes it again. Cross-validation, training, the
registry and scoring use nothing else, so a class of the user's own that is marked with
``model_kind`` goes through all of them.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession


class FittedModel(ABC):
    kind: ClassVar[str]
    name: str
    feature_cols: list[str]

    @abstractmethod
    def transform(self, df: DataFrame, out: str = "pred") -> DataFrame:
        """``df`` with the prediction as column ``out``."""

    @abstractmethod
    def with_interval(self, df: DataFrame, pred: str = "pred", lo: str = "lo", hi: str = "hi",
                      confidence: float = 0.90) -> DataFrame:
        """``df`` with the prediction and its bounds, in one pass."""

    @abstractmethod
    def importance(self) -> list[tuple[str, float]]:
        """(feature, weight), largest first."""

    @abstractmethod
    def attributions(self, df: DataFrame, values: str = "shap_values", base: str = "base_value") -> DataFrame:
        """``df``, each row once, with a map feature -> contribution and the base value; they add up to the prediction."""

    @abstractmethod
    def parts(self, spark: SparkSession) -> tuple[dict, dict[str, DataFrame]]:
        """The model as JSON values and tables."""

    @classmethod
    @abstractmethod
    def from_parts(cls, name: str, feature_cols: list[str], info: dict, table: Callable[[str], DataFrame],
                   members: list[FittedModel]) -> FittedModel:
        """The model that ``parts`` came from; ``table`` reads a stored table."""

    def member_models(self) -> list[FittedModel]:
        """Models that are saved inside this one's entry."""
        return []


KINDS: dict[str, type[FittedModel]] = {}


def model_kind(kind: str):
    """Make a class known to the registry under ``kind``."""
    def mark(cls: type[FittedModel]) -> type[FittedModel]:
        if KINDS.get(kind, cls).__qualname__ != cls.__qualname__:
            raise ValueError(f"model kind {kind!r} is taken by {KINDS[kind].__qualname__}")
        cls.kind = kind
        KINDS[kind] = cls
        return cls
    return mark
