"""Prefix sums and indexes over any number of sorted keys, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import stored


def entity_offsets(counts: DataFrame, entity: str = "entity") -> DataFrame:
    """``entity`` and an ``offset_c`` per column ``c``: the sum of ``c`` over all entities before, in entity order.

    A prefix sum in two levels: entities are dealt into sorted ranges, each range adds up its own entities,
    and only the totals of the ranges (a row per partition) are added up in one place.
    """
    names = [c for c in counts.columns if c != entity]
    ranged = stored(counts.repartitionByRange(entity).withColumn("_range", F.spark_partition_id()), "entity-ranges")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"t_{c}") for c in names])
    ranges = totals.select("_range", *[
        F.coalesce(F.sum(f"t_{c}").over(before.orderBy("_range")), F.lit(0)).alias(f"r_{c}") for c in names])
    inside = {f"i_{c}": F.coalesce(F.sum(c).over(before.partitionBy("_range").orderBy(entity)), F.lit(0)) for c in names}
    return ranged.withColumns(inside).join(ranges, "_range").select(
        entity, *[(F.col(f"r_{c}") + F.col(f"i_{c}")).alias(f"offset_{c}") for c in names])


def entity_index(df: DataFrame, entity: str = "entity") -> DataFrame:
    """``entity, idx``: the distinct entities, numbered from 0 in their order. Nulls have no index. No label
    reaches the driver."""
    distinct = df.where(F.col(entity).isNotNull()).select(entity).distinct().withColumn("one", F.lit(1).cast("long"))
    return entity_offsets(distinct, entity).withColumnRenamed("offset_one", "idx")
