"""Ingestion job: workbooks + rate CSV -> quarterly panel -> parquet.

Prices, CPI and unemployment come from cell tables (``sources.sheets``),
the cash rate from a daily CSV. Drivers are aligned per quarter with one
pivot and broadcast onto the per-entity prices (one row per quarter).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.align import align_drivers, attach_drivers
from panelcast.operators.resample import resample_to_quarter
from panelcast.sources import sheets as sh

DRIVERS = ("cash_rate", "cpi", "unemployment_rate")


def _pick(q: DataFrame, chosen: DataFrame, series_id: str) -> DataFrame:
    return q.join(chosen, ["file", "col_idx"], "left_semi").select(
        F.lit(series_id).alias("series_id"), "period", "value")


def ingest_panel(
    spark: SparkSession, cells: DataFrame, sheets: DataFrame, rate_csv: str, vocabulary: Sequence[str], *,
    price_file: str = "rppi", cpi_file: str = "cpi", labour_file: str = "labour",
    n_header_rows: int = sh.N_HEADER_ROWS,
) -> DataFrame:
    data = sh.sheet_cells(cells, sheets)
    headers = sh.series_headers(data)
    q = sh.quarterly_values(sh.sheet_values(data, n_header_rows))

    ph = headers.where(F.col("file") == price_file)
    prices = q.join(sh.price_series(ph, vocabulary), ["file", "col_idx", "series"], "left_semi")
    prices = prices.select(sh.entity_of(F.col("series"), vocabulary).alias("entity"), "period",
                           F.col("value").alias("price")).where(F.col("entity").isNotNull())

    cpi = _pick(q, sh.cpi_series(headers.where(F.col("file") == cpi_file)), "cpi")
    lh = headers.where(F.col("file") == labour_file)
    unemp = _pick(q, sh.unemployment_series(lh, q.where(F.col("file") == labour_file)), "unemployment_rate")
    rate = resample_to_quarter(
        sh.read_rate_csv(spark, rate_csv).withColumn("series_id", F.lit("cash_rate")), "last")
    drivers = align_drivers(rate.unionByName(cpi).unionByName(unemp), DRIVERS)
    return attach_drivers(prices, drivers).select("entity", "period", "price", *DRIVERS)


def write_panel(panel: DataFrame, path: str) -> None:
    """Parquet sink (overwrite)."""
    panel.write.mode("overwrite").parquet(path)


def load_panel(spark: SparkSession, path: str) -> DataFrame:
    """Parquet source; FileNotFoundError when the panel was never written."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - a missing path is an analysis error
        raise FileNotFoundError(path) from e


def store_panel(panel: DataFrame, name: str, path: str, buckets: int = 8, *, entity: str = "entity",
                period: str = "period") -> DataFrame:
    """The panel as a table bucketed by entity and sorted by (entity, period) inside the buckets; the table, read back.

    Windows per entity over it need no exchange. ``path`` is a folder on shared storage. All rows of an entity
    are in one bucket: its periods, which the calendar bounds.
    """
    rows = panel.repartition(buckets, entity).sortWithinPartitions(entity, period)
    rows.write.bucketBy(buckets, entity).sortBy(entity, period).option("path", path).mode("overwrite").saveAsTable(name)
    return panel.sparkSession.table(name)
