"""Model registry on shared storage: ``{root}/{name}_v{version}/``.

Each entry holds the model's tables (one row per node for trees), the entries of its member
models and, written last, a one-row JSON metadata table (name, version, kind, training_date,
feature_cols, metrics split -> metric -> value, calibration_coverage, and the model's numbers in ``extras``).
The kind names the class (``model_kind``) that makes the model again. Everything is
written with Spark writers, so ``root`` may be any Hadoop file system path
(the default is a folder under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, MapType, StringType, StructField, StructType,
)

from panelcast.ml import blend, effects, linear, trees  # noqa: F401 - their model kinds
from panelcast.ml.model import KINDS, FittedModel
from panelcast.session import scratch_path

METADATA_SCHEMA = StructType([
    StructField("name", StringType()),
    StructField("version", StringType()),
    StructField("kind", StringType()),
    StructField("training_date", StringType()),
    StructField("feature_cols", ArrayType(StringType())),
    StructField("metrics", MapType(StringType(), MapType(StringType(), DoubleType()))),
    StructField("calibration_coverage", DoubleType()),
    StructField("extras", StringType()),
])


def default_root(spark: SparkSession) -> str:
    return scratch_path(spark, "models")


def entry_path(root: str, name: str, version: str) -> str:
    return f"{root.rstrip('/')}/{name}_v{version}"


def save(
    spark: SparkSession, root: str, model: FittedModel, version: str,
    metrics: dict[str, dict[str, float]] | None = None, coverage: float | None = None,
) -> str:
    """Write an entry; its metadata come last, so an entry that can be read is whole."""
    path = entry_path(root, model.name, version)
    members = model.member_models()
    for m in members:
        save(spark, f"{path}/members", m, version)
    info, tables = model.parts(spark)
    for name, rows in tables.items():
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    extras = json.dumps({**info, "_members": [m.name for m in members]})
    meta = (model.name, version, model.kind, dt.datetime.now(dt.timezone.utc).isoformat(),
            list(model.feature_cols), metrics or {}, coverage, extras)
    spark.createDataFrame([meta], METADATA_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return path


def load(spark: SparkSession, root: str, name: str, version: str) -> tuple[FittedModel, dict]:
    """Model and its metadata; FileNotFoundError if the entry is missing, ValueError if no class of its kind is known."""
    path = entry_path(root, name, version)
    try:
        meta = spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata").first()
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    if meta is None:
        raise FileNotFoundError(path)
    if meta.kind not in KINDS:
        raise ValueError(f"{path}: no class is known for models of kind {meta.kind!r}")
    info = json.loads(meta.extras)
    members = [load(spark, f"{path}/members", m, version)[0] for m in info.pop("_members")]
    model = KINDS[meta.kind].from_parts(meta.name, list(meta.feature_cols), info,
                                        lambda table: spark.read.parquet(f"{path}/{table}"), members)
    return model, meta.asDict(recursive=True)


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """One row per entry with its test RMSE (NULL when absent)."""
    meta = spark.read.schema(METADATA_SCHEMA).json(f"{root.rstrip('/')}/*/metadata")
    return meta.withColumn("test_rmse", F.col("metrics")["test"]["rmse"])


def best_model(spark: SparkSession, root: str) -> DataFrame:
    """Entry with the lowest test RMSE; entries without one sort last (a
    value of 0 counts as best). Errors when the registry is empty."""
    listed = list_models(spark, root)
    best = listed.orderBy(F.col("test_rmse").asc_nulls_last(), "name", "version").limit(1)
    if best.count() == 0:
        raise FileNotFoundError(f"no models under {root}")
    return best


def feature_set_matches(meta: dict, current: list[str]) -> bool:
    """Stored feature columns equal the current ones (order included)."""
    return list(meta.get("feature_cols") or []) == list(current)


def load_best(spark: SparkSession, root: str, current: list[str]) -> tuple[FittedModel, dict]:
    """The entry with the lowest test RMSE, checked against the current
    features and with a row scored before it is handed out."""
    best = best_model(spark, root).first()
    model, meta = load(spark, root, best["name"], best["version"])
    if not feature_set_matches(meta, current):
        raise ValueError(f"{meta['name']} was trained on other features than the current ones")
    dry_run(spark, model)
    return model, meta


def dry_run(spark: SparkSession, model: FittedModel) -> None:
    """Score one row of zeros; errors if the model cannot score it or gives no finite number."""
    zeros = spark.range(1).select(*[F.lit(0.0).alias(c) for c in model.feature_cols])
    value = model.transform(zeros, "pred").select("pred").first()[0]
    if value is None or not math.isfinite(value):
        raise ValueError(f"{model.name} scores a row of zeros as {value}")
