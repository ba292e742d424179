"""Batch scoring of request tables with per-row error isolation.

Valid rows are mapped to model inputs and scored by whatever the model is
(``FittedModel``); invalid rows go to an error table
``(request_id, entity, detail)``. Nothing is collected: predictions,
errors and counts are DataFrames. The validated requests are stored once, so that validation and windows run once for both tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.ml.model import FittedModel
from panelcast.operators import requests as rq
from panelcast.session import stored


def error_table(invalid: DataFrame) -> DataFrame:
    return invalid.select("request_id", "entity", F.array_join("errors", "; ").alias("detail"))


def score_vector_requests(
    requests: DataFrame, model: FittedModel, vocabulary: Sequence[str], *,
    model_name: str = "ridge", model_version: str = "1", confidence: float = 0.90,
) -> tuple[DataFrame, DataFrame]:
    """(predictions, errors) for flat feature-vector requests."""
    valid, invalid = rq.split_valid(stored(rq.validate_vector(requests, vocabulary), "requests"))
    scored = model.with_interval(rq.map_vector_request(valid, vocabulary), confidence=confidence)
    year, quarter = rq.next_year_quarter(F.col("year"), F.col("quarter"))
    preds = scored.select(
        "request_id", "entity", year.alias("year"), quarter.alias("quarter"),
        *rq.response_columns(F.col("pred"), F.col("lo"), F.col("hi"), confidence),
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
    )
    return preds, error_table(invalid)


def score_raw_requests(
    requests: DataFrame, model: FittedModel, vocabulary: Sequence[str], *,
    model_name: str = "ridge", model_version: str = "1", confidence: float = 0.90,
) -> tuple[DataFrame, DataFrame]:
    """Histories -> panel -> features -> last complete row -> next quarter.

    Requests whose history yields no complete feature row become errors."""
    valid, invalid = rq.split_valid(stored(rq.validate_raw(requests, vocabulary), "requests"))
    # each valid request once: with its latest complete row, or without features
    latest = rq.raw_latest_features(valid, vocabulary).withColumn("_complete", F.lit(True))
    asked = valid.select("request_id", F.col("entity").alias("_entity")).join(latest, "request_id", "left")
    asked = stored(asked, "asked")
    scored = model.with_interval(asked.where("_complete"), confidence=confidence)
    preds = scored.select(
        "request_id", "entity",
        (F.floor(F.col("predict_period") / 4)).cast("int").alias("year"),
        (F.pmod(F.col("predict_period"), F.lit(4)) + 1).cast("int").alias("quarter"),
        *rq.response_columns(F.col("pred"), F.col("lo"), F.col("hi"), confidence),
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
    )
    short = asked.where("_complete is null").select(
        "request_id", F.col("_entity").alias("entity"),
        F.lit("history too short or with gaps: no quarter has all features").alias("detail"),
    )
    return preds, error_table(invalid).unionByName(short)


def batch_counts(preds: DataFrame, errors: DataFrame) -> DataFrame:
    """success_count and error_count of a scored batch: one global aggregate
    over the union of two narrow projections."""
    marks = preds.select(F.lit(1).alias("ok"), F.lit(0).alias("bad")).unionByName(
        errors.select(F.lit(0).alias("ok"), F.lit(1).alias("bad"))
    )
    return marks.agg(F.sum("ok").cast("long").alias("success_count"), F.sum("bad").cast("long").alias("error_count"))


def explain(inputs: DataFrame, model: FittedModel, keys: list[str]) -> DataFrame:
    """M20 for any model: the rounded prediction, base value (4 dp) and
    contributions (6 dp); ``gap`` is prediction - base - sum of contributions (6 dp, 0 if they add up).
    Every input row gives one row, also if its keys repeat."""
    out = model.attributions(model.transform(inputs, "pred"))
    total = F.aggregate(F.map_values("shap_values"), F.lit(0.0), lambda acc, v: acc + v)
    return out.select(
        *keys, F.round("pred", 4).alias("predicted_qoq_pct_change"), F.round("base_value", 4).alias("base_value"),
        F.transform_values("shap_values", lambda k, v: F.round(v, 6)).alias("shap_values"),
        F.round(F.abs(F.col("pred") - F.col("base_value") - total), 6).alias("gap"))


def contribution_rows(explained: DataFrame, keys: list[str]) -> DataFrame:
    """The contributions of ``explain`` as rows (keys..., feature, contribution, base value, prediction, gap)."""
    rest = [c for c in explained.columns if c not in keys and c != "shap_values"]
    return explained.select(*keys, F.explode("shap_values").alias("feature", "contribution"), *rest)
