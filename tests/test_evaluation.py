"""Metrics, coverage, blends and split/fold rules."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import reports as rep
from panelcast.operators.evaluation import calibration_coverage, evaluate, inverse_mae_weights, z_value
from panelcast.operators.splits import SplitConfig, plan_folds, split_rows, tag_folds, with_split


def metrics(spark, y, pred):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, pred)], "y DOUBLE, pred DOUBLE")
    return evaluate(df).first().asDict()


def test_perfect(spark):
    m = metrics(spark, [1, -0.5, 2], [1, -0.5, 2])
    assert m["mae"] == 0 and m["rmse"] == 0 and m["r2"] == 1 and m["directional_accuracy"] == 1


def test_direction_signs(spark):
    assert metrics(spark, [1, -0.5, 2], [2, -1, 0.5])["directional_accuracy"] == 1
    assert metrics(spark, [1, -0.5, 2], [-1, 0.5, -2])["directional_accuracy"] == 0


def test_zero_actual_excluded_from_mape(spark):
    m = metrics(spark, [0, 1, 2], [0.5, 1.5, 2.5])
    assert m["mape"] == pytest.approx(np.mean([0.5 / 1, 0.5 / 2]) * 100)


def test_all_zero_actuals_mape_null_r2_zero(spark):
    m = metrics(spark, [0, 0], [1, -1])
    assert m["mape"] is None and m["r2"] == 0.0


def test_inverted_and_outlier(spark):
    y, p = np.array([1, 2, 3, 4.0]), np.array([4, 3, 2, 1.0])
    m = metrics(spark, y, p)
    assert m["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    o = metrics(spark, [1, 1, 1, 10], [0, 0, 0, 0])
    assert o["rmse"] > o["mae"]
    assert o["n_samples"] == 4


def test_coverage_inclusive(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 1.0, 2.0), (3.0, 1.0, 2.0)], "y DOUBLE, lo DOUBLE, hi DOUBLE")
    assert calibration_coverage(df).first().coverage == pytest.approx(2 / 3)


def test_weights_sum_to_one_and_favour_lower_mae():
    w = inverse_mae_weights({"a": 1.0, "b": 3.0})
    assert sum(w.values()) == pytest.approx(1.0) and w["a"] > w["b"]
    assert inverse_mae_weights({"a": 0.0, "b": 2.0}) == {"a": 1.0, "b": 0.0}


def test_z_value():
    assert z_value(0.90) == pytest.approx(1.6448536, abs=1e-6)


def test_split_order_and_disjoint(sample_panel):
    cfg = SplitConfig("2016Q4", "2018Q4")
    tr, va, te = (split_rows(sample_panel, s, cfg) for s in ("train", "val", "test"))
    assert tr.agg(F.max("period")).first()[0] < va.agg(F.min("period")).first()[0]
    assert va.agg(F.max("period")).first()[0] < te.agg(F.min("period")).first()[0]
    assert tr.count() + va.count() + te.count() == sample_panel.count()
    labels = {r.split for r in with_split(sample_panel, cfg).select("split").distinct().collect()}
    assert labels == {"train", "val", "test"}


def test_unknown_split(sample_panel):
    with pytest.raises(ValueError):
        split_rows(sample_panel, "holdout", SplitConfig())


def test_fold_plan():
    periods = list(range(100, 148))
    folds = plan_folds(periods, n_splits=3, min_train=16, val=4)
    assert len(folds) == 3
    assert all(f.val_end - f.train_end == 4 for f in folds)
    assert folds[0].train_end == 115
    with pytest.raises(ValueError):
        plan_folds(periods, n_splits=3, min_train=999, val=4)
    with pytest.raises(ValueError):  # exactly min_train + val periods is rejected
        plan_folds(list(range(20)), n_splits=3, min_train=16, val=4)


def test_tag_folds_roles(spark):
    df = spark.createDataFrame([(p,) for p in range(30)], "period INT")
    folds = plan_folds(list(range(30)), 3, 16, 4)
    tagged = tag_folds(df, folds)
    for f in folds:
        val = [r.period for r in tagged.where((F.col("fold") == f.fold) & (F.col("role") == "val")).collect()]
        assert sorted(val) == list(range(f.train_end + 1, f.val_end + 1))
        assert tagged.where((F.col("fold") == f.fold) & (F.col("period") > f.val_end)).count() == 0


def test_histogram_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("a", float(x)) for x in rng.normal(size=200)], "g STRING, v DOUBLE")
    h = rep.histogram(df, "v", ["g"], 25).collect()
    assert len(h) == 25 and sum(r["count"] for r in h) == 200
    assert sum(r.density * (r.bin_hi - r.bin_lo) for r in h) == pytest.approx(1.0)


def test_describe_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v DOUBLE")
    r = rep.describe(df, "v").first()
    assert (r.q25, r.q50, r.q75) == (1.75, 2.5, 3.25) and r["count"] == 4


def _frame(spark, rows):
    return spark.createDataFrame(rows, "model STRING, split STRING, entity STRING, period INT, y DOUBLE, pred DOUBLE, lo DOUBLE, hi DOUBLE")


def test_leaderboard_ranks_by_mae_and_nulls_degenerate_coverage(spark):
    rows = []
    for i in range(4):
        rows.append(("a", "test", "e", i, 1.0, 1.5, 0.0, 2.0))   # mae 0.5, covered
        rows.append(("b", "test", "e", i, 1.0, 1.1, 1.1, 1.1))   # mae 0.1, lo == hi
    lb = {r.model: r for r in rep.leaderboard(_frame(spark, rows)).collect()}
    assert lb["b"].rank == 1 and lb["a"].rank == 2
    assert lb["b"].coverage is None and lb["a"].coverage == 1.0


def test_confusion_and_entity_pivot(spark):
    rows = [("m", "val", "x", 0, 1.0, 0.5, 0.0, 0.0), ("m", "val", "x", 1, -1.0, 0.05, 0.0, 0.0),
            ("m", "val", "y", 0, 0.0, -2.0, 0.0, 0.0)]
    pf = _frame(spark, rows)
    conf = {r.actual: (r.down, r.flat, r.up) for r in rep.direction_confusion(pf).collect()}
    assert conf == {"up": (0, 0, 1), "down": (0, 1, 0), "flat": (1, 0, 0)}
    mae = {r.entity: r.m for r in rep.entity_model_mae(pf.withColumn("split", F.lit("test")), ["m"]).collect()}
    assert mae["x"] == pytest.approx((0.5 + 1.05) / 2) and mae["y"] == pytest.approx(2.0)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [("a" if i % 3 else "b", float(x)) for i, x in enumerate(rng.normal(size=6000))]
    rows += [("c", 5.0), ("d", 1.0), ("d", 2.0)] + [("e", float(v)) for v in [1, 1, 1, 2, 2, 3]]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE")
    got = {r.g: r.q for r in rep.exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"], accuracy=500).collect()}
    for g in "abcde":
        ref = np.quantile([x for k, x in rows if k == g], [0.25, 0.5, 0.75])
        assert got[g] == pytest.approx(list(ref), abs=0, rel=0)
    whole = rep.exact_quantiles(df, "x", [0.5]).first().q
    assert whole[0] == pytest.approx(np.quantile([x for _, x in rows], 0.5), abs=0, rel=0)


def test_ungrouped_histogram_and_kde(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "v DOUBLE")
    h = rep.histogram(df, "v", [], 5).collect()
    assert sum(r["count"] for r in h) == 10 and len(h) == 5
    k = rep.kde(df, "v", [], grid=50).collect()
    assert len(k) == 50 and all(r.density >= 0 for r in k)


def test_exact_quantiles_of_a_million_ties(spark):
    from panelcast.operators.reports import exact_quantiles

    ties = spark.range(1_000_000).select(F.lit("g").alias("g"), F.lit(1.0).alias("v"))
    rest = spark.range(10).select(F.lit("g").alias("g"), (F.col("id") + 2).cast("double").alias("v"))
    found = exact_quantiles(ties.union(rest), "v", [0.0, 0.25, 0.5, 1.0], ["g"]).first()["q"]
    assert found == [1.0, 1.0, 1.0, 11.0]


def test_group_statistics_do_not_meet_in_a_task_per_group(spark):
    from panelcast.operators.reports import exact_quantiles, histogram, kde

    rows = spark.range(100).select((F.col("id") % 2).alias("grp"), F.col("id").cast("double").alias("v"))
    for out in (histogram(rows, "v", ["grp"], 5), kde(rows, "v", ["grp"], 10), exact_quantiles(rows, "v", [0.5], ["grp"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "_part" in plan


def test_fold_plan_follows_its_rule():
    from panelcast.operators.splits import plan_folds

    for total in range(34, 80):
        for n_splits in (1, 3, 5, 20):
            spare = total - 32
            step = max(1, spare // n_splits)
            folds = plan_folds(list(range(total)), n_splits)
            assert len(folds) == len(range(0, spare, step)[:n_splits])
            assert all(f.train_end == 23 + f.fold * step and f.val_end == f.train_end + 8 < total for f in folds)
