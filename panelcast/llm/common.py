"""Helpers shared by the operators: written intermediates, word splitting, vocabulary files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelcast.session import scratch_path, ship_package

#: a vocabulary file larger than this is refused, as it is sent to every executor
VOCABULARY_LIMIT_BYTES = 64 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives lost executors; each call takes a
    folder of its own.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the Python workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def vocabulary_text(path: str) -> str:
    """A vocabulary file as text; its size is checked, as the text is broadcast."""
    size = os.path.getsize(path)
    if size > VOCABULARY_LIMIT_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary may have {VOCABULARY_LIMIT_BYTES}")
    with open(path, encoding="utf-8") as f:
        return f.read()


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A whole table; the folder may be on any storage that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
