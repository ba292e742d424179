"""Quarterly panel derived from the TPC-H-style tables.

entity            nation (or region) of the ordering customer
period            calendar quarter of ``o_orderdate``
price             mean order total of the (entity, quarter) cell
cash_rate         daily mean ``l_discount`` * 100, last day of the quarter
cpi               daily mean unit price ``l_extendedprice / l_quantity``, quarter mean
unemployment_rate monthly share of returned lines (flag 'R') * 100, last month

Every aggregate is partial (map-side) before its shuffle, and lineitem is
scanned once: the three driver series come from one per-day aggregate.
Money and unit prices are summed exactly as scaled integers (cents,
micro-units; ``floor(x * scale + 0.5)``), which is engine-independent and
several times cheaper than wide DECIMAL sums; ANSI mode turns a long
overflow into an error instead of a wrong sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.periods import period_of
from panelcast.operators.align import align_drivers, attach_drivers
from panelcast.operators.resample import resample_to_quarter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# dense one-hot columns are only built for small dimensions;
# features.add_sparse_entity has no such limit
MAX_VOCABULARY = 500

DRIVERS = ("cash_rate", "cpi", "unemployment_rate")


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the testdata folder. The lazy DataFrame is memoised
    per session and path, so file listing and footer reads happen once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def vocabulary(spark: SparkSession, sf_dir: str, level: str = "nation") -> list[str]:
    """Entity names of the dimension table in key order (a fixed-size table:
    25 nations or 5 regions), used as the one-hot vocabulary."""
    if level == "nation":
        dim = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    else:
        dim = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"))
    rows = dim.orderBy("k").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"{level} has more than {MAX_VOCABULARY} values; use sparse encoding")
    return [r.v for r in rows]


def customer_entities(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """(c_custkey, entity). nation/region are fixed-size dimensions; Spark's
    size statistics broadcast them, customer itself is never broadcast. At level
    ``customer`` each customer is an entity of its own."""
    if level == "customer":
        return table(spark, sf_dir, "customer").select(
            "c_custkey", F.concat(F.lit("CUSTOMER_"), F.col("c_custkey").cast("string")).alias("entity"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    if level == "nation":
        dim = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("entity"))
    else:
        region = table(spark, sf_dir, "region")
        dim = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("entity")
        )
    return cust.join(dim, "c_nationkey").select("c_custkey", "entity")


def scaled(x, scale: float):
    """Exact integer units of ``x`` (e.g. cents for scale 100)."""
    return F.floor(x * F.lit(scale) + F.lit(0.5)).cast("long")


def order_prices(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """(entity, period, price, n_orders): mean order total per cell
    (exact sum of cents)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", period_of("o_orderdate").alias("period"),
        scaled(F.col("o_totalprice"), 100.0).alias("amount"),
    )
    cust = customer_entities(spark, sf_dir, level)
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return (
        joined.groupBy("entity", "period")
        .agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n_orders"))
        .select(
            "entity", "period",
            (F.col("total") / F.col("n_orders") / F.lit(100.0)).alias("price"),
            "n_orders",
        )
    )


def daily_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over lineitem -> one row per ship day (bounded by the calendar)."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return (
        li.where(F.col("l_shipdate").isNotNull())
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(
            F.sum(scaled(F.col("l_discount"), 100.0)).alias("disc_sum"),
            F.count("l_discount").alias("disc_n"),
            F.sum(scaled(unit, 1000000.0)).alias("unit_sum"),
            F.count(unit).alias("unit_n"),
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )


def driver_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series table (series_id, obs_date, value) at native frequency.

    Daily cash rate and unit price, monthly return share. Built from the one
    per-day aggregate without a union (a union would re-scan lineitem once per
    branch): monthly totals are a window over the day table, emitted on the
    first day of each month, and ``inline`` turns each day into its rows.
    """
    daily = daily_line_stats(spark, sf_dir).withColumn("month", F.trunc("day", "month"))
    by_month = Window.partitionBy("month")
    first_of_month = F.row_number().over(by_month.orderBy("day")) == 1
    daily = daily.withColumn("unemp", F.when(
        first_of_month,
        F.try_divide(F.sum("returned").over(by_month), F.sum("lines").over(by_month)) * 100,
    ))
    cash = F.try_divide(F.col("disc_sum"), F.col("disc_n"))
    cpi = F.try_divide(F.col("unit_sum"), F.col("unit_n")) / F.lit(1000000.0)

    def obs(name: str, when, value):
        return F.struct(F.lit(name).alias("series_id"), when.alias("obs_date"), value.alias("value"))

    rows = F.array(
        obs("cash_rate", F.col("day"), cash),
        obs("cpi", F.col("day"), cpi),
        obs("unemployment_rate", F.col("month"), F.col("unemp")),
    )
    return daily.select(F.inline(rows)).where(F.col("value").isNotNull())


def quarterly_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period, cash_rate, cpi, unemployment_rate), quarters where all exist.

    Same values as resampling the native series (last day's cash rate, mean
    of daily unit prices, last month's return share) and aligning them, but
    computed day -> month -> quarter with three small aggregates and no
    window or pivot shuffle.
    """
    daily = daily_line_stats(spark, sf_dir)
    cash = F.try_divide(F.col("disc_sum"), F.col("disc_n"))
    cpi = F.try_divide(F.col("unit_sum"), F.col("unit_n")) / F.lit(1000000.0)
    monthly = daily.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.max_by(cash, F.when(cash.isNotNull(), F.col("day"))).alias("cash_last"),
        F.sum(cpi).alias("cpi_sum"), F.count(cpi).alias("cpi_n"),
        F.sum("returned").alias("returned"), F.sum("lines").alias("lines"),
    )
    share = F.try_divide(F.col("returned"), F.col("lines")) * 100
    quarterly = monthly.groupBy(period_of("month").alias("period")).agg(
        F.max_by("cash_last", F.when(F.col("cash_last").isNotNull(), F.col("month"))).alias("cash_rate"),
        F.try_divide(F.sum("cpi_sum"), F.sum("cpi_n")).alias("cpi"),
        F.max_by(share, F.when(share.isNotNull(), F.col("month"))).alias("unemployment_rate"),
    )
    return quarterly.dropna(subset=list(DRIVERS))


def testdata_panel(spark: SparkSession, sf_dir: str, level: str = "nation") -> DataFrame:
    """(entity, period, price, cash_rate, cpi, unemployment_rate)."""
    prices = order_prices(spark, sf_dir, level).select("entity", "period", "price")
    return attach_drivers(prices, quarterly_drivers(spark, sf_dir))


#: the orders lie in the 1990s; requests speak of as many years later, inside the valid range
REQUEST_YEARS_LATER = 10


def _request_quarter() -> tuple[Column, Column]:
    year = (F.floor(F.col("period") / 4) + REQUEST_YEARS_LATER).cast("int").alias("year")
    return year, (F.pmod(F.col("period"), F.lit(4)) + 1).cast("int").alias("quarter")


def vector_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat scoring request per panel cell, filled from the panel history
    (current values, positional lags, lagged rolling stats and momentum).
    Cells without enough history keep NULLs and are rejected by validation."""
    from panelcast.operators import features as feat

    panel = testdata_panel(spark, sf_dir)
    w = feat.panel_window()
    df = feat.add_momentum_features(feat.add_rolling_stats(feat.add_price_changes(panel)))
    return df.select(
        F.concat_ws(":", "entity", F.col("period").cast("string")).alias("request_id"),
        "entity",
        *_request_quarter(),
        F.col("price").alias("rppi_current"),
        F.lag("price", 1).over(w).alias("rppi_lag1"),
        F.lag("price", 2).over(w).alias("rppi_lag2"),
        F.lag("price", 4).over(w).alias("rppi_lag4"),
        F.col("rppi_qoq_pct").alias("rppi_qoq_pct_current"),
        F.col("rppi_yoy_pct").alias("rppi_yoy_pct_current"),
        "rolling_mean_4q", "rolling_std_4q",
        F.col("momentum_streak_lag1").alias("momentum_streak"),
        F.col("price_acceleration_lag1").alias("price_acceleration"),
        "cash_rate",
        F.lag("cash_rate", 1).over(w).alias("cash_rate_prev"),
        "cpi",
        F.lag("cpi", 4).over(w).alias("cpi_prev_year"),
        "unemployment_rate",
        F.lag("unemployment_rate", 1).over(w).alias("unemployment_rate_prev"),
    )


def raw_requests(spark: SparkSession, sf_dir: str, history: int = 6) -> DataFrame:
    """One raw-history request per panel cell: the trailing ``history`` rows of
    the entity (fewer at the start of a series, which validation rejects).
    The frame is a bounded row window, so each array holds <= ``history`` items."""
    from panelcast.operators import features as feat

    panel = testdata_panel(spark, sf_dir)
    w = feat.panel_window().rowsBetween(-(history - 1), 0)
    year, quarter = _request_quarter()
    r = F.struct(year, quarter, F.col("price").alias("rppi_index"))
    m = F.struct(year, quarter, "cash_rate", "cpi", "unemployment_rate")
    return panel.select(
        F.concat_ws(":", "entity", F.col("period").cast("string")).alias("request_id"),
        "entity",
        F.collect_list(r).over(w).alias("rppi_history"),
        F.collect_list(m).over(w).alias("macro_history"),
    )


def faulty_raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw requests with two kinds of faults mixed in: every seventh period's
    macro history lacks its last item, every eleventh's is a year late."""
    requests = raw_requests(spark, sf_dir)
    period = F.element_at(F.split("request_id", ":"), -1).cast("int")
    macro = F.col("macro_history")
    late = F.transform(macro, lambda o: o.withField("year", o["year"] + 1))
    shorter = F.slice(macro, F.lit(1), F.greatest(F.size(macro) - 1, F.lit(0)))
    return requests.withColumn(
        "macro_history", F.when(period % 7 == 0, shorter).when(period % 11 == 0, late).otherwise(macro))


# ---------------------------------------------------------------------------
# Workbook and rate-CSV exports of the testdata series (inputs of the
# ingestion job, written by Spark to shared storage).
# ---------------------------------------------------------------------------

# Descriptive text of the exported workbooks and CSV.
PRICE_HEADER = "Price Index ;  {} ;"
CHANGE_HEADER = "Percentage Change from Previous Period ;  {} ;"
WEIGHTED_HEADER = "Price Index ;  Weighted average of all regions ;"
CPI_HEADERS = ("Index Numbers ;  Food ;", "Index Numbers ;  All groups CPI, national ;")
LABOUR_HEADERS = ("Employed total ;  Persons ;", "Unemployment rate ;  Persons ;  Trend ;",
                  "Unemployment rate ;  Persons ;  Seasonally Adjusted ;")
METADATA_LABELS = ("Unit", "Series Type", "Data Type", "Frequency", "Collection Month",
                   "Series Start", "Series End", "No. Obs", "Series ID")
# free text above the column titles; the file begins with a byte order mark
RATE_CSV_HEAD = (
    "\ufeffRates derived from order totals (test data)",
    "one line per order date; the second column stays empty",
    "Title,Cash Rate Target,Daily step",
    "",
)


def _quarter_end_serial(period) -> object:
    year = F.floor(period / 4).cast("int")
    quarter = F.pmod(period, F.lit(4)) + 1
    end = F.last_day(F.make_date(year, quarter * 3, F.lit(1)))
    return F.datediff(end, F.lit("1899-12-30").cast("date")).cast("string")


def _header_cells(spark: SparkSession, file: str, sheet: str, headers: list[str]) -> DataFrame:
    rows = [(file, sheet, 0, j + 1, h) for j, h in enumerate(headers)]
    rows += [(file, sheet, i + 1, 0, label) for i, label in enumerate(METADATA_LABELS)]
    from panelcast.sources.sheets import CELL_SCHEMA

    return spark.createDataFrame(rows, CELL_SCHEMA)


def workbook_exports(spark: SparkSession, sf_dir: str, level: str = "region"):
    """(cells, sheets, rate_lines): the panel's series in workbook layout.

    Data cells grow with the panel (entities x quarters) and the calendar
    (months, days); header and metadata cells are a fixed handful."""
    vocab = vocabulary(spark, sf_dir, level)
    prices = order_prices(spark, sf_dir, level)
    k = len(vocab)
    pos = F.array_position(F.array(*[F.lit(v) for v in vocab]), F.col("entity")).cast("int")
    row = (F.col("period") + 10).cast("int")
    price_cells = prices.select(
        F.lit("rppi").alias("file"), F.lit("Data1").alias("sheet"), row.alias("row_idx"),
        F.inline(F.array(
            F.struct(pos.alias("col_idx"), F.col("price").cast("string").alias("value")),
            F.struct((pos + k).alias("col_idx"), F.lit("n/a").alias("value")),
        )))
    per_period = prices.groupBy("period").agg(F.avg("price").alias("avg_price"))
    period_cells = per_period.select(
        F.lit("rppi").alias("file"), F.lit("Data1").alias("sheet"), row.alias("row_idx"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("col_idx"), _quarter_end_serial(F.col("period")).alias("value")),
            F.struct(F.lit(2 * k + 1).alias("col_idx"), F.col("avg_price").cast("string").alias("value")),
        )))
    footnote = spark.createDataFrame([("rppi", "Data1", 1 << 20, 0, "Source: derived from the order tables.")],
                                     "file STRING, sheet STRING, row_idx INT, col_idx INT, value STRING")
    price_headers = [PRICE_HEADER.format(v) for v in vocab] + [CHANGE_HEADER.format(v) for v in vocab] + [WEIGHTED_HEADER]

    obs = driver_observations(spark, sf_dir)
    from panelcast.operators.resample import resample_to_quarter

    cpi_q = resample_to_quarter(obs.where(F.col("series_id") == "cpi"), "mean")
    cpi_cells = cpi_q.select(
        F.lit("cpi").alias("file"), F.lit("Data1").alias("sheet"), (F.col("period") + 10).cast("int").alias("row_idx"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("col_idx"), _quarter_end_serial(F.col("period")).alias("value")),
            F.struct(F.lit(1).alias("col_idx"), (F.col("value") * 0.9).cast("string").alias("value")),
            F.struct(F.lit(2).alias("col_idx"), F.col("value").cast("string").alias("value")),
        )))
    months = obs.where(F.col("series_id") == "unemployment_rate")
    month_row = (F.year("obs_date") * 12 + F.month("obs_date") + 10).cast("int")
    labour_cells = months.select(
        F.lit("labour").alias("file"), F.lit("Data1").alias("sheet"), month_row.alias("row_idx"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("col_idx"), F.date_format("obs_date", "yyyy-MM-dd").alias("value")),
            F.struct(F.lit(1).alias("col_idx"), (F.col("value") * 1000).cast("string").alias("value")),
            F.struct(F.lit(2).alias("col_idx"), (F.col("value") + 1).cast("string").alias("value")),
            F.struct(F.lit(3).alias("col_idx"), F.col("value").cast("string").alias("value")),
        )))
    cells = (price_cells.unionByName(period_cells).unionByName(footnote)
             .unionByName(_header_cells(spark, "rppi", "Data1", price_headers))
             .unionByName(cpi_cells).unionByName(_header_cells(spark, "cpi", "Data1", list(CPI_HEADERS)))
             .unionByName(labour_cells).unionByName(_header_cells(spark, "labour", "Data1", list(LABOUR_HEADERS))))
    sheets = spark.createDataFrame(
        [("rppi", 0, "Contents"), ("rppi", 1, "Data1"), ("cpi", 0, "Data1"),
         ("labour", 0, "Index"), ("labour", 1, "Data1"), ("labour", 2, "Enquiries")],
        "file STRING, sheet_idx INT, sheet STRING")

    cash = obs.where(F.col("series_id") == "cash_rate")
    data_lines = cash.select(F.concat_ws(",", F.date_format("obs_date", "dd-MMM-yyyy"),
                                         F.col("value").cast("string"), F.lit("")).alias("value"))
    head = spark.createDataFrame([(line,) for line in RATE_CSV_HEAD], "value STRING")
    return cells, sheets, head.unionByName(data_lines)
