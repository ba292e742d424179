"""Registered queries: each reads the testdata tables of one scale factor.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (DuckDB
SQL over the same parquet views) share one column contract; doubles are
rounded to 6 decimals on both sides by :func:`round6`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.periods import next_period, parse_period, period_label
from panelcast.ml import artifacts as artefacts
from panelcast.ml import registry as reg
from panelcast.ml import scoring as sc
from panelcast.ml.effects import fit_effect_ridge
from panelcast.ml.linear import ALPHAS, fit_ridge, with_val_std
from panelcast.ml.training import KNOWN_MODELS, train_and_evaluate, wide_scores
from panelcast.operators import features as feat
from panelcast.operators import reports as rep
from panelcast.operators import requestlog as rl
from panelcast.operators import requests as rq
from panelcast.operators.align import union_panels
from panelcast.operators.evaluation import metric_exprs
from panelcast.operators.offsets import entity_index
from panelcast.operators.forecasts import BASELINES, ENSEMBLE, baseline_frame, stack
from panelcast.operators.splits import (
    SplitConfig, distinct_periods_list, plan_folds, split_rows, tag_folds, with_split,
)
from panelcast.plans.present import round6
from panelcast.session import scratch_path, stored
from panelcast.sources import ingest as ing
from panelcast.sources import sheets as sh
from panelcast.sources import testdata as td
from panelcast.sources.testdata import testdata_panel, vocabulary
from panelcast.sources.weblinks import discover_links
from panelcast.streaming import jobs as sj

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def panel_and_vocab(spark: SparkSession, sf_dir: str):
    return testdata_panel(spark, sf_dir), vocabulary(spark, sf_dir)


@query("panel")
def q_panel(spark, sf_dir):
    """(entity, period, price, drivers) from the raw tables."""
    return round6(testdata_panel(spark, sf_dir))


@query("price_lags")
def q_price_lags(spark, sf_dir):
    p = feat.add_price_lags(testdata_panel(spark, sf_dir))
    return round6(p.select("entity", "period", "price", "rppi_lag_1", "rppi_lag_2", "rppi_lag_4"))


@query("price_changes")
def q_price_changes(spark, sf_dir):
    p = feat.add_price_changes(testdata_panel(spark, sf_dir))
    return round6(p.select("entity", "period", "rppi_qoq_pct", "rppi_yoy_pct"))


@query("target")
def q_target(spark, sf_dir):
    p = feat.add_target(testdata_panel(spark, sf_dir))
    return round6(p.select("entity", "period", "rppi_qoq_pct", "target"))


@query("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    """training matrix (27+ features and target, complete rows only)."""
    panel, vocab = panel_and_vocab(spark, sf_dir)
    m = feat.build_features(panel, vocab)
    return round6(m.select("entity", "period", *feat.feature_columns(vocab), "target"))


# ---------------------------------------------------------------------------
# Panel build pieces, periods
# ---------------------------------------------------------------------------


# Split boundaries and walk-forward plan for the testdata panel
# (orders span 1995Q1-2001Q3).
TESTDATA_SPLIT = SplitConfig(train_end="1998Q4", val_end="1999Q4")
CV_SPLITS, CV_MIN_TRAIN, CV_VAL = 3, 8, 4
FOCUS_ENTITY = "NATION_1"
MODELS = [*BASELINES, ENSEMBLE]


@query("panel_profile")
def q_panel_profile(spark, sf_dir):
    """Rows, entities and period range of the panel."""
    p = testdata_panel(spark, sf_dir)
    return p.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("entity").alias("n_entities"),
        F.min("period").alias("min_period"), F.max("period").alias("max_period"),
    )


@query("driver_quarterly")
def q_driver_quarterly(spark, sf_dir):
    """Q2/Q3: native-frequency driver series resampled to quarters (last / mean)."""
    from panelcast.operators.resample import resample_to_quarter

    obs = td.driver_observations(spark, sf_dir)
    q = resample_to_quarter(obs, method={"cash_rate": "last", "cpi": "mean", "unemployment_rate": "last"})
    return round6(q)


@query("drivers_aligned")
def q_drivers_aligned(spark, sf_dir):
    """Quarters where all three drivers exist (one pivot aggregate)."""
    return round6(td.quarterly_drivers(spark, sf_dir))


@query("period_labels")
def q_period_labels(spark, sf_dir):
    """Distinct periods with label, next label and label round trip."""
    periods = testdata_panel(spark, sf_dir).select("period").distinct()
    return periods.select(
        "period", period_label("period").alias("label"),
        period_label(next_period("period")).alias("next_label"),
        parse_period(period_label("period")).alias("parsed"),
    )


# ---------------------------------------------------------------------------
# Window features
# ---------------------------------------------------------------------------

def _panel_features(spark, sf_dir, with_target=True):
    panel, vocab = panel_and_vocab(spark, sf_dir)
    return feat.add_all_features(panel, vocab, with_target=with_target), vocab


@query("rolling_stats")
def q_rolling_stats(spark, sf_dir):
    df = feat.add_rolling_stats(feat.add_price_changes(testdata_panel(spark, sf_dir)))
    return round6(df.select("entity", "period", "rppi_qoq_pct", "rolling_mean_4q", "rolling_std_4q"))


@query("lagged_changes")
def q_lagged_changes(spark, sf_dir):
    df = feat.add_lagged_changes(feat.add_price_changes(testdata_panel(spark, sf_dir)))
    return round6(df.select("entity", "period", "rppi_qoq_pct_lag1", "rppi_yoy_pct_lag1"))


@query("momentum")
def q_momentum(spark, sf_dir):
    """Signed streak of the qoq sign, acceleration and their lags."""
    df = feat.add_momentum_features(feat.add_price_changes(testdata_panel(spark, sf_dir)))
    return round6(df.select(
        "entity", "period", "rppi_qoq_pct", "momentum_streak", "momentum_streak_lag1",
        "price_accel", "price_acceleration_lag1",
    ))


@query("macro_features")
def q_macro_features(spark, sf_dir):
    """W8-W10 (partitioned by entity)."""
    df = testdata_panel(spark, sf_dir)
    df = feat.add_unemployment_features(feat.add_cpi_features(feat.add_cash_rate_features(df)))
    return round6(df.select(
        "entity", "period", "cash_rate_delta", "cash_rate_lag1", "cash_rate_delta_lag1",
        "cpi_yoy_pct", "cpi_lag1", "cpi_yoy_pct_lag1", "unemp_delta", "unemp_lag1", "unemp_delta_lag1",
    ))


@query("rate_regime")
def q_rate_regime(spark, sf_dir):
    """F1 on the lagged cash rate."""
    df = feat.add_rate_regime(feat.add_cash_rate_features(testdata_panel(spark, sf_dir)))
    return round6(df.select("entity", "period", "cash_rate_lag1", "rate_regime"))


@query("seasonal")
def q_seasonal(spark, sf_dir):
    df = feat.add_seasonal_features(testdata_panel(spark, sf_dir))
    return round6(df.select("entity", "period", "quarter", "quarter_sin", "quarter_cos"))


@query("entity_dummies")
def q_entity_dummies(spark, sf_dir):
    panel, vocab = panel_and_vocab(spark, sf_dir)
    df = feat.add_entity_dummies(panel, vocab)
    return df.select("entity", "period", *[feat.dummy_name(v) for v in vocab])


@query("rebase")
def q_rebase(spark, sf_dir):
    """Price / first price of the entity * 100."""
    df = feat.rebase(testdata_panel(spark, sf_dir), "price")
    return round6(df.select("entity", "period", "price", "price_rebased"))


@query("acf")
def q_acf(spark, sf_dir):
    """Autocorrelation of qoq change, lags 1..8, averaged over entities."""
    df = feat.add_price_changes(testdata_panel(spark, sf_dir))
    return round6(feat.autocorrelation(df, "rppi_qoq_pct", 8))


@query("inference_matrix")
def q_inference_matrix(spark, sf_dir):
    """complete feature rows without requiring a target."""
    panel, vocab = panel_and_vocab(spark, sf_dir)
    m = feat.build_inference(panel, vocab)
    return round6(m.select("entity", "period", *feat.feature_columns(vocab)))


@query("latest_rows")
def q_latest_rows(spark, sf_dir):
    """last complete feature row per entity and the period it predicts."""
    panel, vocab = panel_and_vocab(spark, sf_dir)
    latest = feat.latest_rows(feat.build_inference(panel, vocab))
    return round6(latest.select("entity", "period", "predict_period", *feat.NUMERIC_FEATURES))


# ---------------------------------------------------------------------------
# Splits, prediction frame, reports
# ---------------------------------------------------------------------------

def features_of(spark, sf_dir):
    panel, vocab = panel_and_vocab(spark, sf_dir)
    return feat.build_features(panel, vocab), vocab


def frame_of(spark, sf_dir):
    features, _ = features_of(spark, sf_dir)
    return baseline_frame(features, TESTDATA_SPLIT)


@query("splits")
def q_splits(spark, sf_dir):
    """Split label of every training row."""
    features, _ = features_of(spark, sf_dir)
    return with_split(features, TESTDATA_SPLIT).select("entity", "period", "split")


@query("split_sizes")
def q_split_sizes(spark, sf_dir):
    features, _ = features_of(spark, sf_dir)
    return rep.split_sizes(with_split(features, TESTDATA_SPLIT))


@query("prediction_frame")
def q_prediction_frame(spark, sf_dir):
    """M3/M8/M9: baselines with residual-std intervals and their inverse-MAE blend."""
    return round6(frame_of(spark, sf_dir))


@query("metrics_by_split")
def q_metrics_by_split(spark, sf_dir):
    """A1/A6."""
    return round6(rep.metrics_by_split(frame_of(spark, sf_dir)))


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    """A2."""
    return round6(rep.model_comparison(frame_of(spark, sf_dir)))


@query("coverage")
def q_coverage(spark, sf_dir):
    """A3 on the validation split."""
    return round6(rep.interval_coverage(frame_of(spark, sf_dir)))


@query("leaderboard")
def q_leaderboard(spark, sf_dir):
    """A5."""
    return round6(rep.leaderboard(frame_of(spark, sf_dir)))


@query("period_means")
def q_period_means(spark, sf_dir):
    """A7."""
    return round6(rep.period_means(frame_of(spark, sf_dir)))


@query("interval_series")
def q_interval_series(spark, sf_dir):
    """A8."""
    return round6(rep.interval_series(frame_of(spark, sf_dir), FOCUS_ENTITY))


@query("entity_model_mae")
def q_entity_model_mae(spark, sf_dir):
    """A9."""
    return round6(rep.entity_model_mae(frame_of(spark, sf_dir), MODELS))


@query("residual_summary")
def q_residual_summary(spark, sf_dir):
    """A10 (moments)."""
    return round6(rep.residual_summary(frame_of(spark, sf_dir)))


@query("residual_histogram")
def q_residual_histogram(spark, sf_dir):
    """A10 (25-bin density histogram per model)."""
    return round6(rep.residual_histogram(frame_of(spark, sf_dir)))


def _target_parts(spark, sf_dir):
    features, _ = features_of(spark, sf_dir)
    part = F.when(F.col("period") <= TESTDATA_SPLIT.val_end_p, "train_val").otherwise("test")
    return features.withColumn("part", part).withColumn(
        "nbins", F.when(F.col("part") == "train_val", 30).otherwise(15)
    )


@query("target_histogram")
def q_target_histogram(spark, sf_dir):
    """30 bins for train+val, 15 for test."""
    return round6(rep.histogram(_target_parts(spark, sf_dir), "target", ["part"], "nbins"))


@query("describe_target")
def q_describe_target(spark, sf_dir):
    """A12."""
    return rep.describe(_target_parts(spark, sf_dir), "target", ["part"])


@query("rate_target_fit")
def q_rate_target_fit(spark, sf_dir):
    """Target on cash rate, train split."""
    features, _ = features_of(spark, sf_dir)
    train = features.where(F.col("period") <= TESTDATA_SPLIT.train_end_p)
    return round6(rep.linear_fit(train, "cash_rate", "target"))


@query("seasonal_target")
def q_seasonal_target(spark, sf_dir):
    """A14."""
    features, _ = features_of(spark, sf_dir)
    return round6(rep.seasonal_profile(features))


@query("feature_target_corr")
def q_feature_target_corr(spark, sf_dir):
    """A15 over all model inputs, train split."""
    features, vocab = features_of(spark, sf_dir)
    train = features.where(F.col("period") <= TESTDATA_SPLIT.train_end_p)
    return round6(rep.feature_target_corr(train, feat.feature_columns(vocab)))


@query("correlation_matrix")
def q_correlation_matrix(spark, sf_dir):
    """A16 over the 19 numeric features."""
    features, _ = features_of(spark, sf_dir)
    return round6(rep.correlation_matrix(features, feat.NUMERIC_FEATURES))


@query("driver_ranges")
def q_driver_ranges(spark, sf_dir):
    """A17 (drivers per split)."""
    features, _ = features_of(spark, sf_dir)
    return round6(rep.driver_ranges(with_split(features, TESTDATA_SPLIT), td.DRIVERS))


@query("target_by_entity")
def q_target_by_entity(spark, sf_dir):
    """A17 (target per entity)."""
    features, _ = features_of(spark, sf_dir)
    return round6(rep.target_by_entity(features))


@query("residual_spread")
def q_residual_spread(spark, sf_dir):
    """A18."""
    return round6(rep.residual_spread(frame_of(spark, sf_dir)))


@query("direction_confusion")
def q_direction_confusion(spark, sf_dir):
    """A19 (counts)."""
    return rep.direction_confusion(frame_of(spark, sf_dir))


@query("direction_accuracy")
def q_direction_accuracy(spark, sf_dir):
    """A19 (accuracy)."""
    return round6(rep.direction_accuracy(frame_of(spark, sf_dir)))


@query("direction_by_entity")
def q_direction_by_entity(spark, sf_dir):
    """A20."""
    return round6(rep.direction_by_entity(frame_of(spark, sf_dir), MODELS))


@query("residual_series")
def q_residual_series(spark, sf_dir):
    """A24."""
    return round6(rep.residual_series(frame_of(spark, sf_dir)))


@query("pred_actual_bounds")
def q_pred_actual_bounds(spark, sf_dir):
    """A26."""
    return round6(rep.pred_actual_bounds(frame_of(spark, sf_dir)))


def _folds(features):
    return plan_folds(distinct_periods_list(features), CV_SPLITS, CV_MIN_TRAIN, CV_VAL)


@query("walk_forward_folds")
def q_walk_forward_folds(spark, sf_dir):
    """M14 fold plan from the distinct periods of the training matrix."""
    from panelcast.operators.splits import fold_table

    features, _ = features_of(spark, sf_dir)
    return fold_table(spark, _folds(features))


def _cv_metrics(spark, sf_dir):
    features, _ = features_of(spark, sf_dir)
    folds = _folds(features)
    base = features.select("entity", "period", F.col("target").alias("y"), *[
        F.col(c).alias(f"pred_{m}") for m, c in BASELINES.items()
    ])
    val = tag_folds(base, folds).where(F.col("role") == "val")
    long = val.select("fold", "y", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").alias("pred")) for m in BASELINES
    ])))
    return long.groupBy("fold", "model").agg(*metric_exprs())


@query("cv_fold_metrics")
def q_cv_fold_metrics(spark, sf_dir):
    """M14 metrics per fold for the baseline forecasters."""
    return round6(_cv_metrics(spark, sf_dir))


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    """A23."""
    return round6(rep.cv_summary(_cv_metrics(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Models (rows-only checks: fits are iterative, not SQL)
# ---------------------------------------------------------------------------


TOP_K = 15


#: queries about the second boosted model train it alone
LEAF_FIRST = ("gbt_es",)


def ml_inputs(spark, sf_dir):
    """Stored training matrix (lineage cut before the iterative fits)."""
    features, vocab = features_of(spark, sf_dir)
    return stored(features, "training-matrix"), feat.feature_columns(vocab)


def ridge_of(features, cols):
    train = split_rows(features, "train", TESTDATA_SPLIT)
    val = split_rows(features, "val", TESTDATA_SPLIT)
    return with_val_std(fit_ridge(train, cols), val)


@query("ridge_predictions")
def q_ridge_predictions(spark, sf_dir):
    """M1-M3: standardised ridge (alpha by contiguous 5-fold CV), residual-std interval."""
    features, cols = ml_inputs(spark, sf_dir)
    model = ridge_of(features, cols)
    wide = wide_scores(features, TESTDATA_SPLIT, {"ridge": model})
    return round6(stack(wide, ["ridge"], with_bounds=True))


def _top_k(spark, pairs):
    """Top-k importances normalised to the largest."""
    top = pairs[:TOP_K]
    peak = max((v for _, v in top), default=0.0) or 1.0
    rows = [(i + 1, f, float(v), float(v) / peak) for i, (f, v) in enumerate(top)]
    return spark.createDataFrame(rows, "rank INT, feature STRING, importance DOUBLE, relative DOUBLE")


@query("ridge_importance")
def q_ridge_importance(spark, sf_dir):
    """|coefficient| ranking."""
    features, cols = ml_inputs(spark, sf_dir)
    return round6(_top_k(spark, ridge_of(features, cols).importance()))


@query("ridge_attribution")
def q_ridge_attribution(spark, sf_dir):
    """Mean |contribution| per feature over all test rows, top 15.
    One aggregate with a column per feature, then stacked and ranked."""
    features, cols = ml_inputs(spark, sf_dir)
    model = ridge_of(features, cols)
    test = split_rows(features, "test", TESTDATA_SPLIT)
    wide = test.agg(*[F.avg(F.abs(F.lit(model.coef[j]) * model.z(j))).alias(f"a{j}") for j in range(len(cols))])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"a{j}").alias("mean_abs_attribution")) for j, c in enumerate(cols)
    ])))
    return round6(long.orderBy(F.desc("mean_abs_attribution"), "feature").limit(TOP_K))


@query("ridge_explain")
def q_ridge_explain(spark, sf_dir):
    """Additive contributions of every test row and feature, and the base value; their sum is the prediction."""
    features, cols = ml_inputs(spark, sf_dir)
    model = ridge_of(features, cols)
    test = model.attributions(model.transform(split_rows(features, "test", TESTDATA_SPLIT)), "contributions")
    return round6(test.select("entity", "period", "pred", "base_value",
                              F.explode("contributions").alias("feature", "contribution")))


def _ridge_folds(spark, sf_dir):
    from panelcast.ml.cv import walk_forward_cv

    features, cols = ml_inputs(spark, sf_dir)
    return walk_forward_cv(features, cols, "ridge", n_splits=CV_SPLITS, min_train=CV_MIN_TRAIN, val=CV_VAL)


@query("ridge_walk_forward")
def q_ridge_walk_forward(spark, sf_dir):
    """Expanding-window folds, ridge refit per fold, validation metrics."""
    return round6(_ridge_folds(spark, sf_dir))


@query("ridge_cv_summary")
def q_ridge_cv_summary(spark, sf_dir):
    """A23 for ridge."""
    return round6(rep.cv_summary(_ridge_folds(spark, sf_dir)))


def _input_mark(spark, sf_dir):
    """Changes whenever a file of the tables that the panel is built from does."""
    files = [spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{sf_dir.rstrip('/')}/{t}.parquet")
             .select("path", "length", "modificationTime") for t in ("orders", "lineitem", "customer", "nation", "region")]
    every = files[0]
    for f in files[1:]:
        every = every.unionByName(f)
    return every.agg(F.expr("hex(bit_xor(xxhash64(path, length, modificationTime)))")).first()[0]


def _trained(spark, sf_dir, models=KNOWN_MODELS):
    """Folder of the training job's results in the shared folder: the registry
    (``models``) and the prediction frame (``frame``). Made once for the
    tables as they are, the models asked for and the code, and read back by every query."""
    key = artefacts.artefact_key(_input_mark(spark, sf_dir), {"models": list(models)})

    def make(folder):
        features, cols = ml_inputs(spark, sf_dir)
        done = train_and_evaluate(features, TESTDATA_SPLIT, cols, models, registry_root=f"{folder}/models")
        done.frame.write.parquet(f"{folder}/frame")

    return artefacts.artefact(scratch_path(spark, "training"), key, make)


def _training_frame(spark, sf_dir):
    return spark.read.parquet(f"{_trained(spark, sf_dir)}/frame")


@query("training_metrics")
def q_training_metrics(spark, sf_dir):
    """M13 (+M4-M9): ridge, searched GBT, early-stopped GBT and their blend;
    metrics for every model and split in one aggregate."""
    return round6(_training_frame(spark, sf_dir).groupBy("model", "split").agg(*metric_exprs()))


@query("training_frame")
def q_training_frame(spark, sf_dir):
    """M13 long prediction frame with intervals."""
    return round6(_training_frame(spark, sf_dir))


@query("training_coverage")
def q_training_coverage(spark, sf_dir):
    """Validation interval coverage of every trained model."""
    val = _training_frame(spark, sf_dir).where(F.col("split") == "val")
    return round6(val.groupBy("model").agg(F.avg(rep.inside()).alias("coverage"), F.count(F.lit(1)).alias("n")))


@query("gbt_importance")
def q_gbt_importance(spark, sf_dir):
    """M10/A21 for the early-stopped boosted trees, loaded from the registry."""
    model, _ = reg.load(spark, f"{_trained(spark, sf_dir, LEAF_FIRST)}/models", "gbt_es", "1")
    return round6(_top_k(spark, model.importance()))


@query("blend_importance")
def q_blend_importance(spark, sf_dir):
    """Importance of the blend, loaded from the registry."""
    model, _ = reg.load(spark, f"{_trained(spark, sf_dir)}/models", ENSEMBLE, "1")
    return round6(_top_k(spark, model.importance()))


@query("registry_ranking")
def q_registry_ranking(spark, sf_dir):
    """Entries with the test RMSE of the baseline models, one of 0 and
    one without any, listed and ranked (missing last); the first is the best."""
    features, cols = ml_inputs(spark, sf_dir)
    model = ridge_of(features, cols)
    root = scratch_path(spark, f"registry-ranking-{uuid.uuid4().hex[:12]}")
    known = {r["model"]: float(r["rmse"]) for r in rep.leaderboard(frame_of(spark, sf_dir)).collect()}  # a row per model
    for name, rmse in {**known, "exact": 0.0, "unrated": None}.items():
        reg.save(spark, root, replace(model, name=name), "1", {} if rmse is None else {"test": {"rmse": rmse}})
    best = reg.best_model(spark, root).first()["name"]
    rank = F.row_number().over(Window.orderBy(F.col("test_rmse").asc_nulls_last(), "name"))  # a row per entry
    return round6(reg.list_models(spark, root).select(
        "name", "version", "test_rmse", rank.alias("rank"), (F.col("name") == best).alias("is_best")))


@query("model_registry")
def q_model_registry(spark, sf_dir):
    """Save the ridge model with its metrics, list the registry and
    pick the best entry by test RMSE."""
    features, cols = ml_inputs(spark, sf_dir)
    model = ridge_of(features, cols)
    wide = wide_scores(features, TESTDATA_SPLIT, {"ridge": model})
    frame = stack(wide, ["ridge"], with_bounds=True)
    m = frame.groupBy("split").agg(*metric_exprs(names=("mae", "rmse", "r2", "directional_accuracy"))).collect()
    metrics = {r.split: {k: float(r[k]) for k in ("mae", "rmse", "r2", "directional_accuracy")} for r in m}
    cov = frame.where(F.col("split") == "val").agg(F.avg(rep.inside())).first()[0]
    root = scratch_path(spark, f"registry-{uuid.uuid4().hex[:12]}")
    reg.save(spark, root, model, "1", metrics, cov)
    loaded, meta = reg.load(spark, root, "ridge", "1")
    if not reg.feature_set_matches(meta, cols):
        raise ValueError("stored feature columns differ from the current ones")
    reg.dry_run(spark, loaded)
    return reg.best_model(spark, root).select("name", "version", "kind", "feature_cols", "test_rmse", "calibration_coverage")


# ---------------------------------------------------------------------------
# Requests, scoring, links, request log, streams
# ---------------------------------------------------------------------------


# Fixed value: href pattern of the link-discovery query.
LINK_PATTERN = "tion|ment"


@query("vector_requests")
def q_vector_requests(spark, sf_dir):
    """F7 input: flat scoring requests derived from every panel cell."""
    return round6(td.vector_requests(spark, sf_dir))


@query("vector_request_errors")
def q_vector_request_errors(spark, sf_dir):
    """rule violations of the vector requests (valid rows excluded)."""
    reqs = td.vector_requests(spark, sf_dir)
    _, invalid = rq.split_valid(rq.validate_vector(reqs, vocabulary(spark, sf_dir)))
    return sc.error_table(invalid)


@query("vector_features")
def q_vector_features(spark, sf_dir):
    """model inputs mapped from the valid requests, and the response
    fields (rounding, direction) of a forecast that repeats the current change."""
    vocab = vocabulary(spark, sf_dir)
    valid, _ = rq.split_valid(rq.validate_vector(td.vector_requests(spark, sf_dir), vocab))
    change = F.col("rppi_qoq_pct_current")
    year, quarter = rq.next_year_quarter(F.col("year"), F.col("quarter"))
    answer = [year.alias("next_year"), quarter.alias("next_quarter"),
              *rq.response_columns(change, change - 1, change + 1)]
    with_answer = valid.select("*", *answer)
    inputs = rq.map_vector_request(with_answer, vocab)
    answers = ["next_year", "next_quarter", "predicted_qoq_pct_change", "direction", "lower", "upper", "confidence"]
    return round6(inputs.select("request_id", *feat.feature_columns(vocab), *answers))


@query("raw_panel")
def q_raw_panel(spark, sf_dir):
    """Raw histories paired positionally into (request, period) rows."""
    return round6(rq.raw_to_panel(td.raw_requests(spark, sf_dir)))


@query("raw_request_errors")
def q_raw_request_errors(spark, sf_dir):
    """raw-history rule violations (lengths, periods, ranges)."""
    reqs = td.faulty_raw_requests(spark, sf_dir)
    _, invalid = rq.split_valid(rq.validate_raw(reqs, vocabulary(spark, sf_dir)))
    return sc.error_table(invalid)


def _scoring_model(spark, sf_dir):
    """The best model of a registry of fitted ridges (alphas of the whole grid and one alone), checked and
    dry-run as a service would load it."""
    features, cols = ml_inputs(spark, sf_dir)
    train, val, test = (split_rows(features, s, TESTDATA_SPLIT) for s in ("train", "val", "test"))
    root = scratch_path(spark, f"serving-{uuid.uuid4().hex[:12]}")
    for name, alphas in (("ridge", ALPHAS), ("ridge_stiff", (max(ALPHAS),))):
        model = replace(with_val_std(fit_ridge(train, cols, alphas=alphas), val), name=name)
        rmse = test.agg(F.sqrt(F.avg(F.pow(F.col("target") - model.prediction(), 2)))).first()[0]
        reg.save(spark, root, model, "1", {"test": {"rmse": rmse}})
    best, _ = reg.load_best(spark, root, cols)
    return best, vocabulary(spark, sf_dir)


@query("score_vector_requests")
def q_score_vector_requests(spark, sf_dir):
    """Valid vector requests scored (next quarter, interval, direction)."""
    model, vocab = _scoring_model(spark, sf_dir)
    preds, _ = sc.score_vector_requests(td.vector_requests(spark, sf_dir), model, vocab, model_name=model.name)
    return preds


@query("batch_counts")
def q_batch_counts(spark, sf_dir):
    """Success and error counts of the scored request batch."""
    model, vocab = _scoring_model(spark, sf_dir)
    preds, errors = sc.score_vector_requests(td.vector_requests(spark, sf_dir), model, vocab)
    return sc.batch_counts(preds, errors)


@query("score_raw_requests")
def q_score_raw_requests(spark, sf_dir):
    """Raw histories -> features per request -> last row -> prediction."""
    model, vocab = _scoring_model(spark, sf_dir)
    preds, _ = sc.score_raw_requests(td.raw_requests(spark, sf_dir), model, vocab, model_name=model.name)
    return preds


@query("raw_scoring_errors")
def q_raw_scoring_errors(spark, sf_dir):
    """M19 error table (invalid requests and histories without a feature row)."""
    model, vocab = _scoring_model(spark, sf_dir)
    _, errors = sc.score_raw_requests(td.faulty_raw_requests(spark, sf_dir), model, vocab)
    return errors


@query("explain_vector_requests")
def q_explain_vector_requests(spark, sf_dir):
    """M20 (vector): per-request contributions and base value."""
    model, vocab = _scoring_model(spark, sf_dir)
    valid, _ = rq.split_valid(rq.validate_vector(td.vector_requests(spark, sf_dir), vocab))
    keys = ["request_id", "entity"]
    return round6(sc.contribution_rows(sc.explain(rq.map_vector_request(valid, vocab), model, keys), keys))


@query("explain_raw_requests")
def q_explain_raw_requests(spark, sf_dir):
    """M20 (raw): contributions for the last complete row of each history."""
    model, vocab = _scoring_model(spark, sf_dir)
    valid, _ = rq.split_valid(rq.validate_raw(td.raw_requests(spark, sf_dir), vocab))
    latest = rq.raw_latest_features(valid, vocab)
    keys = ["request_id", "entity", "predict_period"]
    return round6(sc.contribution_rows(sc.explain(latest, model, keys), keys))


@query("link_discovery")
def q_link_discovery(spark, sf_dir):
    """First matching anchor link of every stored page (NULL if none)."""
    return discover_links(td.table(spark, sf_dir, "pages"), LINK_PATTERN)


@query("request_counts")
def q_request_counts(spark, sf_dir):
    """Requests per (endpoint, status) from the event log."""
    return rl.request_counts(rl.events_as_requests(td.table(spark, sf_dir, "events")))


@query("latency_histogram")
def q_latency_histogram(spark, sf_dir):
    """Cumulative latency buckets per endpoint."""
    return round6(rl.latency_histogram(rl.events_as_requests(td.table(spark, sf_dir, "events"))))


def _stream_dirs(spark, tag):
    base = scratch_path(spark, f"stream-{tag}-{uuid.uuid4().hex[:12]}")
    return f"{base}/out", f"{base}/checkpoint"


@query("stream_request_metrics")
def q_stream_request_metrics(spark, sf_dir):
    """Hourly request metrics from the event log as a stream (watermarked
    event-time windows; the latest update of each window, so the result is whole)."""
    events = td.table(spark, sf_dir, "events")
    out, ckpt = _stream_dirs(spark, "metrics")
    res = sj.request_metrics_stream(spark, sf_dir, events.schema, out, ckpt,
                                    output_mode="update", file_glob="events.parquet")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return round6(res.select(
        F.date_format("window_start", fmt).alias("window_start"), F.date_format("window_end", fmt).alias("window_end"),
        *[c for c in res.columns if c not in ("window_start", "window_end")],
    ))


@query("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """Vector requests scored as a stream (foreachBatch to prediction and
    error tables); the requests are first written to the shared folder."""
    model, vocab = _scoring_model(spark, sf_dir)
    out, ckpt = _stream_dirs(spark, "scoring")
    src = out.rsplit("/", 1)[0] + "/requests"
    reqs = td.vector_requests(spark, sf_dir)
    reqs.write.mode("overwrite").parquet(src)
    preds, errors = sj.scoring_stream(
        spark, src, reqs.schema, out, ckpt,
        lambda batch: sc.score_vector_requests(batch, model, vocab, model_name=model.name),
    )
    return preds.drop("batch_id").unionByName(
        errors.select("request_id", "entity", "detail"), allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Ingestion from workbooks and the rate CSV
# ---------------------------------------------------------------------------


def _exported(spark, sf_dir):
    """Write the workbook cells and the rate CSV to the shared folder (as a
    delivery would) and return the paths."""
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex[:12]}")
    cells, sheets, lines = td.workbook_exports(spark, sf_dir, "region")
    cells.write.mode("overwrite").parquet(f"{base}/cells")
    sheets.write.mode("overwrite").parquet(f"{base}/sheets")
    lines.write.mode("overwrite").text(f"{base}/rates")
    return base


@query("ingest_round_trip")
def q_ingest_round_trip(spark, sf_dir):
    """Workbooks + rate CSV -> quarterly region panel -> parquet -> reload."""
    base = _exported(spark, sf_dir)
    cells = spark.read.parquet(f"{base}/cells")
    sheets = spark.read.parquet(f"{base}/sheets")
    panel = ing.ingest_panel(spark, cells, sheets, f"{base}/rates", vocabulary(spark, sf_dir, "region"))
    ing.write_panel(panel, f"{base}/panel")
    return round6(ing.load_panel(spark, f"{base}/panel"))


@query("rate_csv_series")
def q_rate_csv_series(spark, sf_dir):
    """The daily cash-rate column read back from the exported CSV."""
    base = _exported(spark, sf_dir)
    return round6(sh.read_rate_csv(spark, f"{base}/rates"))


@query("sheet_headers")
def q_sheet_headers(spark, sf_dir):
    """Data-sheet choice, cleaned and de-duplicated series names,
    and the series each selection rule picks."""
    base = _exported(spark, sf_dir)
    cells = sh.sheet_cells(spark.read.parquet(f"{base}/cells"), spark.read.parquet(f"{base}/sheets"))
    headers = sh.series_headers(cells)
    q = sh.quarterly_values(sh.sheet_values(cells))
    vocab = vocabulary(spark, sf_dir, "region")
    picked = (
        sh.price_series(headers.where(F.col("file") == "rppi"), vocab).select("file", "col_idx", F.lit("price").alias("role"))
        .unionByName(sh.cpi_series(headers.where(F.col("file") == "cpi")).select("file", "col_idx", F.lit("cpi").alias("role")))
        .unionByName(sh.unemployment_series(headers.where(F.col("file") == "labour"), q.where(F.col("file") == "labour"))
                     .select("file", "col_idx", F.lit("unemployment").alias("role")))
    )
    return headers.join(picked, ["file", "col_idx"], "left").select("file", "col_idx", "raw", "series", "role")


# ---------------------------------------------------------------------------
# Tree attributions
# ---------------------------------------------------------------------------

def _es_tree(spark, sf_dir):
    features, _ = features_of(spark, sf_dir)
    return features, reg.load(spark, f"{_trained(spark, sf_dir, LEAF_FIRST)}/models", "gbt_es", "1")[0]


@query("gbt_explain")
def q_gbt_explain(spark, sf_dir):
    """Tree SHAP contributions of the boosted trees for every test row."""
    features, model = _es_tree(spark, sf_dir)
    return sc.explain(split_rows(features, "test", TESTDATA_SPLIT), model, ["entity", "period"])


@query("gbt_attribution")
def q_gbt_attribution(spark, sf_dir):
    """A22 for the boosted trees: mean |contribution| over all test rows, top 15."""
    features, model = _es_tree(spark, sf_dir)
    ex = model.attributions(split_rows(features, "test", TESTDATA_SPLIT))
    long = ex.select(F.explode("shap_values").alias("feature", "value"))
    agg = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_attribution"))
    return round6(agg.orderBy(F.desc("mean_abs_attribution"), "feature").limit(TOP_K))


@query("quantile_intervals")
def q_quantile_intervals(spark, sf_dir):
    """M7: 5 % / 95 % quantile boosting (pinball loss) with all settings of the searched model, fitted on the training
    rows; coverage and mean width of the interval per split."""
    features, model = _es_tree(spark, sf_dir)
    inside = ((F.col("target") >= F.col("lo")) & (F.col("target") <= F.col("hi"))).cast("double")
    return round6(with_split(model.with_interval(features), TESTDATA_SPLIT).groupBy("split").agg(
        F.avg(inside).alias("coverage"), F.avg(F.col("hi") - F.col("lo")).alias("mean_width"),
        F.avg((F.col("lo") > F.col("hi")).cast("double")).alias("crossing_share"),
        F.count(F.lit(1)).alias("n"),
    ))


@query("panel_union")
def q_panel_union(spark, sf_dir):
    """The panels of both levels as one."""
    return round6(union_panels(*[
        testdata_panel(spark, sf_dir, level).select(
            F.lit(level).alias("level"), "entity", "period", "price", "cash_rate", "cpi", "unemployment_rate")
        for level in ("nation", "region")]))


@query("target_kde")
def q_target_kde(spark, sf_dir):
    """A11 (KDE): Gaussian density of the target, train+val vs test, 200 points."""
    return round6(rep.kde(_target_parts(spark, sf_dir), "target", ["part"]))


@query("gbt_walk_forward")
def q_gbt_walk_forward(spark, sf_dir):
    """Walk-forward CV of the early-stopped boosted trees (pluggable model)."""
    from panelcast.ml.cv import walk_forward_cv

    features, cols = ml_inputs(spark, sf_dir)
    return round6(walk_forward_cv(features, cols, "gbt_es", n_splits=CV_SPLITS, min_train=CV_MIN_TRAIN, val=CV_VAL))


# ---------------------------------------------------------------------------
# Many entities, stored panels
# ---------------------------------------------------------------------------


@query("entity_index")
def q_entity_index(spark, sf_dir):
    """customers with orders, numbered in name order without a window over all of them."""
    return entity_index(testdata_panel(spark, sf_dir, "customer"))


@query("customer_ridge")
def q_customer_ridge(spark, sf_dir):
    """Ridge with an effect per customer (no column per customer), alpha by validation RMSE; every row's
    prediction and its customer's effect."""
    features = stored(feat.build_features(testdata_panel(spark, sf_dir, "customer"), []), "customer-matrix")
    train, val = split_rows(features, "train", TESTDATA_SPLIT), split_rows(features, "val", TESTDATA_SPLIT)
    model = fit_effect_ridge(train, val, feat.feature_columns([]))
    scored = model.attributions(model.transform(with_split(features, TESTDATA_SPLIT), "pred"))
    return round6(scored.select("entity", "period", "split", F.col("target").alias("y"), "pred",
                                F.col("shap_values")["entity"].alias("effect")))


@query("stored_panel_features")
def q_stored_panel_features(spark, sf_dir):
    """The training matrix from a panel stored in buckets of entities: its windows need no exchange."""
    panel, vocab = panel_and_vocab(spark, sf_dir)
    name = f"panel_{uuid.uuid4().hex[:12]}"
    table = ing.store_panel(panel, name, scratch_path(spark, f"stored-{name}"))
    return round6(feat.build_features(table, vocab).select("entity", "period", "target", *feat.feature_columns(vocab)))
