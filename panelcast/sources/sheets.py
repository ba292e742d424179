"""Statistical-workbook parsing on a cell table, and the rate CSV reader.

Workbooks arrive as cells ``(file, sheet, row_idx, col_idx, value STRING)``
plus a sheet list ``(file, sheet_idx, sheet)`` (the container codec is out
of scope). Layout: row 0 holds series descriptions, data starts at row
``n_header_rows``; column 0 holds dates (ISO text or spreadsheet serials).
Everything is set-based: header tables are tiny (one row per column), value
cells are joined to their row's date and column's series name.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelcast.functions.periods import excel_serial_to_date, period_of
from panelcast.functions.scalars import clean_series_name, nan_to_null

CELL_SCHEMA = "file STRING, sheet STRING, row_idx INT, col_idx INT, value STRING"
SHEET_SCHEMA = "file STRING, sheet_idx INT, sheet STRING"

# Layout and selection patterns.
N_HEADER_ROWS = 10
DATA_SHEET = r"(?i)^(Data\d+|Table\s*\d+)"
WEIGHTED = r"(?i)(weighted|eight)"
CPI_SERIES = r"(?i)(all groups|all )"
RATE_DATE = r"^\d{2}-\w{3}-\d{4}"
RATE_HEADER_FIRST_FIELD = "title"
RATE_SERIES = "cash rate target"
BIG = 1 << 30


def data_sheet(sheets: DataFrame) -> DataFrame:
    """(file, sheet) - first sheet named like ``Data1`` / ``Table 1``,
    else the second sheet, else the first."""
    match = F.col("sheet").rlike(DATA_SHEET)
    key = (F.when(match, F.col("sheet_idx"))
           .when(F.col("sheet_idx") == 1, F.lit(BIG))
           .when(F.col("sheet_idx") == 0, F.lit(BIG + 1))
           .otherwise(F.lit(BIG + 2)))
    return sheets.groupBy("file").agg(F.min_by("sheet", key).alias("sheet"))


def sheet_cells(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """Cells of each file's data sheet (semi-join on a one-row-per-file table)."""
    return cells.join(data_sheet(sheets), ["file", "sheet"], "left_semi")


def series_headers(cells: DataFrame) -> DataFrame:
    """(file, col_idx, raw, series): cleaned names, repeats suffixed _1, _2 ..."""
    raw = cells.where((F.col("row_idx") == 0) & (F.col("col_idx") >= 1)).select(
        "file", "col_idx", F.col("value").alias("raw"))
    named = raw.withColumn("name", clean_series_name(F.coalesce(F.col("raw"), F.lit(""))))
    rn = F.row_number().over(Window.partitionBy("file", "name").orderBy("col_idx"))
    return named.withColumn("series", F.when(rn == 1, F.col("name")).otherwise(
        F.concat(F.col("name"), F.lit("_"), (rn - 1).cast("string")))).drop("name")


def date_cell(value: Column) -> Column:
    """Numbers are serial dates (checked first: a bare number would also
    parse as a far-future year), otherwise ISO dates; anything else is NULL."""
    num = nan_to_null(F.trim(value).try_cast("double"))
    iso = F.coalesce(F.try_to_date(F.trim(value), "yyyy-MM-dd"),
                     F.to_date(F.try_to_timestamp(F.trim(value), F.lit("yyyy-MM-dd HH:mm:ss"))))
    return F.when(num.isNotNull(), excel_serial_to_date(num)).otherwise(iso)


def sheet_values(cells: DataFrame, n_header_rows: int = N_HEADER_ROWS) -> DataFrame:
    """Long values (file, col_idx, series, raw, row_idx, obs_date, value)
    of date rows; footnotes and blank dates are dropped, bad numbers are NULL."""
    data = cells.where(F.col("row_idx") >= n_header_rows)
    dates = data.where(F.col("col_idx") == 0).select(
        "file", "row_idx", date_cell(F.col("value")).alias("obs_date")).where(F.col("obs_date").isNotNull())
    vals = data.where(F.col("col_idx") >= 1).select(
        "file", "row_idx", "col_idx", nan_to_null(F.col("value").try_cast("double")).alias("value"))
    return vals.join(dates, ["file", "row_idx"]).join(series_headers(cells), ["file", "col_idx"])


def quarterly_values(values: DataFrame) -> DataFrame:
    """Last non-null value per (file, series, quarter) in row order."""
    return (values.where(F.col("value").isNotNull())
            .groupBy("file", "col_idx", "series", "raw", period_of("obs_date").alias("period"))
            .agg(F.max_by("value", "row_idx").alias("value")))


def price_series(headers: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Per file, the column named exactly as each entity, plus the first
    weighted-average column; every column when none qualifies."""
    exact = F.col("series").isin(list(vocabulary))
    weighted = F.col("series").rlike(WEIGHTED) & ~exact
    first_weighted = F.min(F.when(weighted, F.col("col_idx"))).over(Window.partitionBy("file"))
    marked = headers.withColumn("keep", exact | (F.col("col_idx") == F.coalesce(first_weighted, F.lit(-1))))
    marked = marked.withColumn("any_kept", F.max(F.col("keep").cast("int")).over(Window.partitionBy("file")))
    return marked.where(F.col("keep") | (F.col("any_kept") == 0)).select("file", "col_idx", "series")


def entity_of(series: Column, vocabulary: Sequence[str]) -> Column:
    """The first listed entity contained in the series name."""
    return F.coalesce(*[F.when(series.contains(v), F.lit(v)) for v in vocabulary], F.lit(None).cast("string"))


def cpi_series(headers: DataFrame) -> DataFrame:
    """First 'all groups' column per file, else the first column."""
    key = F.when(F.lower("series").rlike(CPI_SERIES), F.col("col_idx")).otherwise(F.col("col_idx") + BIG)
    return headers.groupBy("file").agg(F.min_by("col_idx", key).alias("col_idx"))


def unemployment_series(headers: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Raw header with unemployment+rate+seasonally, else unemployment+rate,
    else the first column with > 20 values of which > 80 % lie in [2, 15];
    a file without any raises an error when evaluated."""
    h = F.lower(F.col("raw"))
    has_ur = h.contains("unemployment") & h.contains("rate")
    profile = quarterly.groupBy("file", "col_idx").agg(
        F.count("value").alias("n"), F.avg(F.col("value").between(2, 15).cast("double")).alias("share"))
    ranked = headers.join(profile, ["file", "col_idx"], "left").withColumn(
        "prio",
        F.when(has_ur & h.contains("seasonally"), 0).when(has_ur, 1)
        .when((F.col("n") > 20) & (F.col("share") > 0.8), 2))
    chosen = ranked.where(F.col("prio").isNotNull()).groupBy("file").agg(
        F.min_by("col_idx", F.struct("prio", "col_idx")).alias("col_idx"))
    files = headers.select("file").distinct()
    return files.join(chosen, "file", "left").select(
        "file", F.coalesce(F.col("col_idx"), F.raise_error(F.concat(
            F.lit("no unemployment rate series in "), F.col("file")))).cast("int").alias("col_idx"))


def read_rate_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily (obs_date, value) of the cash-rate column of a rate CSV.

    The header row is found by content (first field 'Title'), data rows by
    the ``dd-Mon-yyyy`` pattern; the value column is the header naming the
    cash rate target, else the first column with more than 50 numbers.
    Only the header line and one count per column reach the driver; the
    CSV is read with an explicit all-string schema as wide as the header.
    """
    lines = spark.read.text(path)
    first_field = F.lower(F.trim(F.regexp_replace(F.split(F.col("value"), ",").getItem(0), "^\ufeff", "")))
    head = lines.where(first_field == RATE_HEADER_FIRST_FIELD).limit(1).collect()
    if head:
        header = next(csv.reader([head[0].value]))
    else:
        width = lines.where(F.col("value").rlike(RATE_DATE)).agg(F.max(F.size(F.split("value", ",")))).first()[0] or 1
        header = [""] * width
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(len(header))])
    raw = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)
    cols = raw.columns
    first = F.regexp_replace(F.col(cols[0]), "^\ufeff", "")
    data = raw.where(F.trim(first).rlike(RATE_DATE))
    target = next((cols[i] for i in range(1, len(header)) if RATE_SERIES in header[i].lower()), None)
    if target is None and len(cols) > 1:
        counts = data.agg(*[F.count(F.col(c).try_cast("double")).alias(c) for c in cols[1:]]).first()
        target = next((c for c in cols[1:] if counts[c] > 50), None)
    if target is None:
        raise ValueError(f"no cash rate column in {path}")
    out = data.select(
        F.try_to_date(F.trim(first), "dd-MMM-yyyy").alias("obs_date"),
        nan_to_null(F.col(target).try_cast("double")).alias("value"),
    )
    return out.where(F.col("obs_date").isNotNull() & F.col("value").isNotNull())
