"""Period helpers, name cleaning, resampling, workbook/CSV parsing, link discovery."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions.periods import excel_serial_to_date, parse_period, period_label, period_to_int
from panelcast.functions.scalars import clean_series_name
from panelcast.operators.resample import resample_to_quarter
from panelcast.sources import sheets as sh
from panelcast.sources.ingest import load_panel
from panelcast.sources.weblinks import discover_links


def test_excel_serial(spark):
    known = (dt.date(2003, 9, 30) - dt.date(1899, 12, 30)).days
    df = spark.createDataFrame([(1.0,), (float(known),), (37865.7,)], "s DOUBLE")
    got = [r.d for r in df.select(excel_serial_to_date("s").alias("d")).collect()]
    assert got == [dt.date(1899, 12, 31), dt.date(2003, 9, 30), dt.date(2003, 9, 1)]


@pytest.mark.parametrize("raw,expected", [
    ("Price Index ;  Alpha ;", "Alpha"),
    ("Price Index ;  Weighted average of all regions ;", "Weighted average of all regions"),
    ("Bravo", "Bravo"),
    ("  Index ;  Charlie  ;  ", "Charlie"),
])
def test_clean_series_name(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw STRING")
    assert df.select(clean_series_name("raw").alias("n")).first().n == expected


def test_period_labels(spark):
    df = spark.createDataFrame([(2019 * 4 + 3,)], "p INT")
    r = df.select(period_label("p").alias("l"), parse_period(F.lit("2020q1")).alias("n")).first()
    assert r.l == "2019Q4" and r.n == 2020 * 4
    assert period_to_int("2018Q4") == 2018 * 4 + 3
    with pytest.raises(ValueError):
        period_to_int("2018-12")


def test_resample_last_and_mean(spark):
    days = [dt.date(2010, 1, 1) + dt.timedelta(days=i) for i in range(90)]
    df = spark.createDataFrame([("r", d, float(i)) for i, d in enumerate(days)], "series_id STRING, obs_date DATE, value DOUBLE")
    last = resample_to_quarter(df, "last").first()
    mean = resample_to_quarter(df, "mean").first()
    assert last.period == 2010 * 4 and last.value == 89.0
    assert mean.value == pytest.approx(44.5)


RATE_CSV = (
    "\ufeffInterest rates - daily series\n"
    "Title,Cash Rate Target,Change in Cash Rate Target\n"
    "Description,Policy rate target,Change in target\n"
    "Frequency,Daily,Daily\nType,Original,Original\nUnits,Per cent per annum,Percentage points\n"
    "Source,Central bank,Central bank\nPublication date,2024-01-15,2024-01-15\nSeries ID,RATE1,RATE2\n"
    "Unique identifier,RATE1,RATE2\n\n\n"
    "04-Jan-2011,4.75,\n05-Jan-2011,4.75,\n06-Jan-2011,4.75,\n01-Nov-2011,4.50,-0.25\n"
)


def test_rate_csv(spark, tmp_path):
    path = tmp_path / "f1.csv"
    path.write_text(RATE_CSV, encoding="utf-8")
    rows = sorted(sh.read_rate_csv(spark, str(path)).collect())
    assert [r.obs_date for r in rows] == [dt.date(2011, 1, 4), dt.date(2011, 1, 5), dt.date(2011, 1, 6), dt.date(2011, 11, 1)]
    assert all(0 <= r.value <= 30 for r in rows) and rows[-1].value == 4.5


def workbook(spark):
    cells = [("wb", "Data1", 0, 1, "Index ;  Alpha ;"), ("wb", "Data1", 0, 2, "Index ;  Alpha ;"),
             ("wb", "Data1", 0, 3, "Unemployment rate ;  Persons ;  Seasonally Adjusted ;")]
    cells += [("wb", "Data1", i, 0, "meta") for i in range(1, 10)]
    months = [(2010, 1), (2010, 2), (2010, 3), (2010, 4)]
    for k, (y, m) in enumerate(months):
        row = 10 + k
        serial = str((dt.date(y, m, 1) - dt.date(1899, 12, 30)).days)
        cells += [("wb", "Data1", row, 0, serial if k % 2 == 0 else f"{y}-{m:02d}-01"),
                  ("wb", "Data1", row, 1, str(100 + k)), ("wb", "Data1", row, 2, "x" if k == 2 else str(k)),
                  ("wb", "Data1", row, 3, str(5.0 + k / 10))]
    cells.append(("wb", "Data1", 20, 0, "Footnote: source"))
    sheets = [("wb", 0, "Contents"), ("wb", 1, "Notes"), ("wb", 2, "Data1")]
    return spark.createDataFrame(cells, sh.CELL_SCHEMA), spark.createDataFrame(sheets, sh.SHEET_SCHEMA)


def test_workbook_parsing(spark):
    cells, sheets = workbook(spark)
    assert sh.data_sheet(sheets).first().sheet == "Data1"
    data = sh.sheet_cells(cells, sheets)
    names = {r.col_idx: r.series for r in sh.series_headers(data).collect()}
    assert names == {1: "Alpha", 2: "Alpha_1", 3: "Seasonally Adjusted"}
    q = {(r.series, r.period): r.value for r in sh.quarterly_values(sh.sheet_values(data)).collect()}
    assert q[("Alpha", 2010 * 4)] == 102.0          # last month of Q1
    assert q[("Alpha_1", 2010 * 4)] == 1.0          # last non-null (row 12 is not a number)
    assert q[("Alpha", 2010 * 4 + 1)] == 103.0
    assert len([k for k in q if k[0] == "Alpha"]) == 2  # footnote row dropped


def test_sheet_fallbacks(spark):
    sheets = spark.createDataFrame([("a", 0, "Index"), ("a", 1, "Whatever"), ("b", 0, "Only")], sh.SHEET_SCHEMA)
    got = {r.file: r.sheet for r in sh.data_sheet(sheets).collect()}
    assert got == {"a": "Whatever", "b": "Only"}


def test_unemployment_rule_order(spark):
    cells, sheets = workbook(spark)
    data = sh.sheet_cells(cells, sheets)
    headers = sh.series_headers(data)
    chosen = sh.unemployment_series(headers, sh.quarterly_values(sh.sheet_values(data))).first()
    assert chosen.col_idx == 3


def test_missing_panel(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_panel(spark, str(tmp_path / "nope"))


def test_link_discovery(spark):
    html = ('<html><script>var a = "<a href=\\"/skip.xlsx\\">";</script><!-- <a href="/c.xlsx"> -->'
            '<a class="x" href="/files/other.pdf">o</a><a href="/media/641601.XLSX">t</a>'
            '<a href="https://cdn.example.org/b.xlsx">b</a></html>')
    pages = spark.createDataFrame([(1, "https://site.example.com/release?x=1", html),
                                   (2, "http://other.example.com/", "<p>none</p>")], "page_id LONG, url STRING, html STRING")
    got = {r.page_id: r.link for r in discover_links(pages, r"\.xlsx$").collect()}
    assert got == {1: "https://site.example.com/media/641601.XLSX", 2: None}


def test_link_discovery_whole_pages_match_python(spark):
    import re as _re

    from panelcast.sources.weblinks import ANCHOR_HREF, ORIGIN, SCRIPT_OR_COMMENT

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.link for r in discover_links(pages, "tion|ment").collect()}
    for r in pages.collect():
        body = _re.sub(SCRIPT_OR_COMMENT, "", r.html)
        hrefs = _re.findall("(?i)" + ANCHOR_HREF, body)
        hit = next((h for h in hrefs if _re.search("(?i)tion|ment", h)), None)
        if hit is None:
            want = None
        elif hit.startswith("http"):
            want = hit
        else:
            want = _re.match(ORIGIN, r.url).group(1) + hit if _re.match(ORIGIN, r.url) else hit
        assert got[r.page_id] == want, r.page_id
