"""Registered queries against their DuckDB twins on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"

# a cross-section of operator families (the full set runs in tools/oracle_check.py)
SUBSET = ["panel", "feature_matrix", "momentum", "acf", "latest_rows", "split_sizes", "prediction_frame",
          "leaderboard", "model_comparison", "residual_histogram", "describe_target", "residual_spread",
          "direction_confusion", "cv_summary", "vector_request_errors", "raw_request_errors", "link_discovery",
          "latency_histogram"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_twins_are_registered():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70


@pytest.mark.parametrize("name", SUBSET)
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert ours == theirs


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "target" in df.columns
