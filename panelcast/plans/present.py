"""Result presentation shared by registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round6(df: DataFrame) -> DataFrame:
    """Doubles as ``round(x * 1e6) / 1e6`` (same IEEE steps as the SQL twins)."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            c = (F.round(c.cast("double") * 1000000.0) / 1000000.0).alias(field.name)
        cols.append(c)
    return df.select(*cols)
