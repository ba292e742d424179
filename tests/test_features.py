"""Window features: values, no cross-entity leakage, streak semantics."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.functions.scalars import rate_regime
from panelcast.operators import features as feat

from .conftest import ENTITIES


def by_key(df, *cols):
    return {(r.entity, r.period): tuple(r[c] for c in cols) for r in df.collect()}


def test_lags_do_not_leak_across_entities(two_entity_panel):
    out = by_key(feat.add_price_lags(two_entity_panel), "rppi_lag_1", "rppi_lag_2", "rppi_lag_4")
    first_mel = min(p for (e, p) in out if e == "Bravo")
    assert out[("Bravo", first_mel)] == (None, None, None)
    assert out[("Bravo", first_mel + 1)][0] == 200.0


def test_lag_values(two_entity_panel):
    out = by_key(feat.add_price_lags(two_entity_panel), "rppi_lag_1", "rppi_lag_4")
    p = 2015 * 4 + 6
    assert out[("Alpha", p)] == (105.0, 102.0)


def test_price_changes(two_entity_panel):
    out = by_key(feat.add_price_changes(two_entity_panel), "rppi_qoq_pct", "rppi_yoy_pct")
    p = 2015 * 4 + 4
    assert out[("Alpha", p)][0] == pytest.approx((104 / 103 - 1) * 100)
    assert out[("Alpha", p)][1] == pytest.approx((104 / 100 - 1) * 100)
    assert out[("Alpha", 2015 * 4)] == (None, None)


def test_input_not_mutated(two_entity_panel):
    cols = list(two_entity_panel.columns)
    feat.add_all_features(two_entity_panel, ["Alpha", "Bravo"])
    assert two_entity_panel.columns == cols


def test_rolling_stats_match_list_maths(sample_panel):
    df = feat.add_rolling_stats(feat.add_price_changes(sample_panel)).where(F.col("entity") == "Echo")
    rows = sorted(df.select("period", "rppi_qoq_pct", "rolling_mean_4q", "rolling_std_4q").collect())
    qoq = [r.rppi_qoq_pct for r in rows]
    for i, r in enumerate(rows):
        window = [x for x in qoq[max(0, i - 4):i] if x is not None]
        if len(window) < 2:
            assert r.rolling_mean_4q is None and r.rolling_std_4q is None
        else:
            assert r.rolling_mean_4q == pytest.approx(np.mean(window))
            assert r.rolling_std_4q == pytest.approx(np.std(window, ddof=1))


def streak_loop(values):
    out, run, prev = [], 0, None
    for v in values:
        if v is None or (isinstance(v, float) and math.isnan(v)):
            out.append(None)
            run, prev = 0, None
            continue
        s = (v > 0) - (v < 0)
        if s == 0:
            out.append(0.0)
            run, prev = 0, 0
            continue
        run = run + 1 if s == prev else 1
        prev = s
        out.append(float(s * run))
    return out


def streak_of(spark, values):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "entity STRING, period INT, x DOUBLE")
    out = df.withColumn("s", feat.signed_streak("x", feat.panel_window()))
    return [r.s for r in sorted(out.collect(), key=lambda r: r.period)]


@pytest.mark.parametrize("values,expected", [
    ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0]),
    ([-1.0, -2.0, -0.5], [-1.0, -2.0, -3.0]),
    ([1.0, -1.0, 1.0, 1.0], [1.0, -1.0, 1.0, 2.0]),
    ([1.0, None, 1.0], [1.0, None, 1.0]),
    ([1.0, 0.0, 1.0, 2.0], [1.0, 0.0, 1.0, 2.0]),
])
def test_streak_cases(spark, values, expected):
    assert streak_of(spark, values) == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from([-2.0, -1.0, 0.0, 1.0, 3.0])), min_size=1, max_size=12))
def test_streak_matches_loop(spark, values):
    assert streak_of(spark, values) == streak_loop(values)


def test_momentum_lags_stay_in_entity(two_entity_panel):
    df = feat.add_momentum_features(feat.add_price_changes(two_entity_panel))
    out = by_key(df, "momentum_streak_lag1", "price_acceleration_lag1")
    assert out[("Bravo", 2015 * 4)] == (None, None)
    assert out[("Bravo", 2015 * 4 + 1)][0] is None


def test_macro_features(spark):
    rows = [("a", i, 100.0, 4.5 - 0.1 * i, 100.0 + i, 5.5 - 0.05 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "entity STRING, period INT, price DOUBLE, cash_rate DOUBLE, cpi DOUBLE, unemployment_rate DOUBLE")
    df = feat.add_unemployment_features(feat.add_cpi_features(feat.add_cash_rate_features(df)))
    r = {x.period: x for x in df.collect()}
    assert r[0].cash_rate_lag1 is None and r[1].cash_rate_delta_lag1 is None
    assert r[2].cash_rate_delta_lag1 == pytest.approx(-0.1)
    assert r[4].cpi_yoy_pct == pytest.approx((104 / 100 - 1) * 100)
    assert r[5].cpi_yoy_pct_lag1 == pytest.approx((104 / 100 - 1) * 100)
    assert r[3].unemp_lag1 == pytest.approx(5.4)


def test_target_is_next_qoq(two_entity_panel):
    out = by_key(feat.add_target(two_entity_panel), "rppi_qoq_pct", "target")
    p = 2015 * 4 + 3
    assert out[("Alpha", p)][1] == pytest.approx(out[("Alpha", p + 1)][0])
    assert out[("Alpha", 2015 * 4 + 9)][1] is None


def test_rate_regime_edges(spark):
    df = spark.createDataFrame([(x,) for x in (None, 0.5, 1.0, 2.99, 3.0, 5.99, 6.0, 9.0)], "r DOUBLE")
    got = [r.g for r in df.select(rate_regime("r").alias("g")).collect()]
    assert got == [None, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0]


def test_seasonal_values(spark):
    df = spark.createDataFrame([(2020 * 4 + q,) for q in range(4)], "period INT")
    rows = sorted(feat.add_seasonal_features(df).collect())
    assert [r.quarter for r in rows] == [1, 2, 3, 4]
    assert rows[0].quarter_sin == pytest.approx(1.0)
    assert rows[1].quarter_cos == pytest.approx(-1.0)


def test_dummies_unknown_entity_all_zero(spark):
    df = spark.createDataFrame([("Nowhere", 1)], "entity STRING, period INT")
    row = feat.add_entity_dummies(df, ENTITIES).first()
    assert all(row[feat.dummy_name(v)] == 0 for v in ENTITIES)


def test_inference_needs_six_periods(spark, sample_panel):
    six = sample_panel.where((F.col("entity") == "Alpha") & (F.col("period") < 2010 * 4 + 6))
    five = sample_panel.where((F.col("entity") == "Alpha") & (F.col("period") < 2010 * 4 + 5))
    assert feat.build_inference(six, ENTITIES).count() == 1
    assert feat.build_inference(five, ENTITIES).count() == 0


def test_training_matrix_has_no_nulls_and_target(sample_panel):
    m = feat.build_features(sample_panel, ENTITIES)
    cols = feat.feature_columns(ENTITIES) + ["target"]
    nulls = m.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    assert all(v == 0 for v in nulls)
    # 40 periods: 5 lost to look-back, 1 to the target
    assert m.count() == 8 * 34


def test_latest_rows_predict_next_period(sample_panel):
    latest = feat.latest_rows(feat.build_inference(sample_panel, ENTITIES))
    rows = latest.collect()
    assert len(rows) == 8
    assert all(r.period == 2010 * 4 + 39 and r.predict_period == r.period + 1 for r in rows)


def test_rebase_starts_at_100(two_entity_panel):
    out = by_key(feat.rebase(two_entity_panel, "price"), "price_rebased")
    assert out[("Bravo", 2015 * 4)][0] == pytest.approx(100.0)
    assert out[("Bravo", 2015 * 4 + 2)][0] == pytest.approx(202 / 200 * 100)


def test_feature_windows_share_one_exchange(sample_panel):
    m = feat.build_features(sample_panel, ENTITIES)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(entity") <= 1


def test_sparse_entity_code_equals_the_dense_one(spark):
    names = [f"n{i:04d}" for i in range(700)]
    rows = [(n,) for n in names] + [(None,), ("n0003",)]
    from panelcast.operators.features import add_sparse_entity

    out = add_sparse_entity(spark.createDataFrame(rows, "entity string")).collect()
    for r in out:
        hot = [] if r["entity"] is None else [names.index(r["entity"])]
        assert r["entity_vec"].size == 700 and r["entity_vec"].indices.tolist() == hot
