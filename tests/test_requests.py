"""Request validation, positional history pairing and scoring."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelcast.ml import scoring as sc
from panelcast.ml.linear import fit_ridge, with_val_std
from panelcast.operators import features as feat
from panelcast.operators import requests as rq
from panelcast.operators.splits import SplitConfig, split_rows

from .conftest import ENTITIES

VECTOR_SCHEMA = (
    "request_id STRING, entity STRING, quarter INT, year INT, " + ", ".join(f"{f} DOUBLE" for f in rq.VECTOR_FIELDS)
)

GOOD = dict(rppi_current=150.0, rppi_lag1=148.0, rppi_lag2=147.0, rppi_lag4=145.0, rppi_qoq_pct_current=1.35,
            rppi_yoy_pct_current=3.4, rolling_mean_4q=0.9, rolling_std_4q=0.5, momentum_streak=None,
            price_acceleration=None, cash_rate=1.5, cash_rate_prev=1.75, cpi=115.0, cpi_prev_year=112.0,
            unemployment_rate=5.2, unemployment_rate_prev=5.3)


def vector_df(spark, variants):
    rows = []
    for i, (entity, over) in enumerate(variants):
        v = {**GOOD, **over}
        rows.append((f"r{i}", entity, 2, 2019, *[v[f] for f in rq.VECTOR_FIELDS]))
    return spark.createDataFrame(rows, VECTOR_SCHEMA)


@pytest.fixture(scope="module")
def model(sample_panel):
    m = feat.build_features(sample_panel, ENTITIES)
    cfg = SplitConfig("2016Q4", "2018Q4")
    return with_val_std(fit_ridge(split_rows(m, "train", cfg), feat.feature_columns(ENTITIES)), split_rows(m, "val", cfg))


def test_vector_validation_variants(spark):
    df = vector_df(spark, [("Alpha", {}), ("Atlantis", {}), ("Alpha", {"rppi_current": -10.0}),
                           ("Alpha", {"cash_rate": 35.0}), ("Alpha", {"rppi_lag4": 50.0})])
    errs = {r.request_id: r.errors for r in rq.validate_vector(df, ENTITIES).collect()}
    assert errs["r0"] == []
    assert errs["r1"] == ["entity: not a known entity"]
    assert "rppi_current: must be greater than 0" in errs["r2"]
    assert errs["r3"] == ["cash_rate: must be between 0 and 30"]
    assert any("plausible" in e for e in errs["r4"])


def test_defaults_and_mapping(spark):
    df = rq.map_vector_request(rq.with_defaults(vector_df(spark, [("Alpha", {})])), ENTITIES)
    r = df.first()
    assert r.momentum_streak_lag1 == 0.0 and r.price_acceleration_lag1 == 0.0
    assert r.cash_rate_delta_lag1 == pytest.approx(-0.25)
    assert r.rate_regime == 1.0 and r.rppi_qoq_pct_lag1 == 1.35
    assert r.cpi_yoy_pct_lag1 == pytest.approx((115 / 112 - 1) * 100)
    assert r[feat.dummy_name("Alpha")] == 1 and r[feat.dummy_name("Echo")] == 0


def test_batch_scoring_isolates_errors(spark, model):
    df = vector_df(spark, [("Alpha", {}), ("Atlantis", {}), ("Echo", {})])
    preds, errors = sc.score_vector_requests(df, model, ENTITIES)
    p = {r.request_id: r for r in preds.collect()}
    assert set(p) == {"r0", "r2"}
    assert (p["r0"].year, p["r0"].quarter) == (2019, 3)
    assert p["r0"].lower <= p["r0"].predicted_qoq_pct_change <= p["r0"].upper
    assert p["r0"].direction in ("up", "down", "flat")
    assert [r.request_id for r in errors.collect()] == ["r1"]
    c = sc.batch_counts(preds, errors).first()
    assert (c.success_count, c.error_count) == (2, 1)


def raw_df(spark, n=6, start=2019 * 4, entity="Alpha", macro_shift=0, macro_len=None, rid="q"):
    def yq(p):
        return p // 4, p % 4 + 1
    r = [(*yq(start + i), 150.0 + i) for i in range(n)]
    m = [(*yq(start + i + macro_shift), 1.5, 115.0 + i, 5.2) for i in range(macro_len or n)]
    return spark.createDataFrame([(rid, entity, [dict(zip(("year", "quarter", "rppi_index"), x)) for x in r],
                                   [dict(zip(("year", "quarter", "cash_rate", "cpi", "unemployment_rate"), x)) for x in m])],
                                 rq.RAW_SCHEMA)


def test_raw_scoring_predicts_next_quarter(spark, model):
    preds, errors = sc.score_raw_requests(raw_df(spark), model, ENTITIES)
    r = preds.first()
    assert (r.year, r.quarter) == (2020, 3)  # 2019Q1-2020Q2 -> 2020Q3
    assert errors.count() == 0


@pytest.mark.parametrize("kw,msg", [
    ({"n": 5}, "must have 6 to 40 items"),
    ({"macro_len": 7}, "same length"),
    ({"macro_shift": 1}, "period mismatch"),
    ({"start": 1999 * 4}, "year must be between"),
])
def test_raw_validation_errors(spark, model, kw, msg):
    preds, errors = sc.score_raw_requests(raw_df(spark, **kw), model, ENTITIES)
    assert preds.count() == 0
    assert msg in errors.first().detail


def test_raw_pairing_is_positional(spark):
    rows = rq.raw_to_panel(raw_df(spark)).orderBy("period").collect()
    assert [r.period for r in rows] == list(range(2019 * 4, 2019 * 4 + 6))
    assert rows[2].price == 152.0 and rows[2].cpi == 117.0


def test_explain_additive(spark, model):
    inputs = rq.map_vector_request(rq.with_defaults(vector_df(spark, [("Alpha", {})])), ENTITIES)
    twice = inputs.unionAll(inputs)  # repeated request ids stay rows of their own
    rows = sc.explain(twice, model, ["request_id"]).collect()
    assert len(rows) == 2
    for r in rows:
        assert sum(r.shap_values.values()) + r.base_value == pytest.approx(r.predicted_qoq_pct_change, abs=1e-3)
        assert r.gap == 0.0
