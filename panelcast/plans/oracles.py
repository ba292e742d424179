"""DuckDB SQL twins of the registered queries (independent of the DataFrame code)."""

from __future__ import annotations

import math
import re

from panelcast.operators.features import NUMERIC_FEATURES, dummy_name
from panelcast.plans.sqlgen import NATION_VOCAB, feature_ctes, r6, with_features, with_panel

ORACLES: dict[str, str] = {}

FEATURE_COLS = NUMERIC_FEATURES + [dummy_name(v) for v in NATION_VOCAB]


def cols6(*names: str) -> str:
    return ", ".join(r6(n, n) for n in names)


ORACLES["panel"] = with_panel(
    f"SELECT entity, period, {cols6('price', 'cash_rate', 'cpi', 'unemployment_rate')} FROM panel"
)

ORACLES["price_lags"] = with_panel(f"""
SELECT entity, period, {r6('price', 'price')},
       {r6('lag(price, 1) OVER w', 'rppi_lag_1')},
       {r6('lag(price, 2) OVER w', 'rppi_lag_2')},
       {r6('lag(price, 4) OVER w', 'rppi_lag_4')}
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period)""")

ORACLES["price_changes"] = with_panel(f"""
SELECT entity, period,
       {r6('(price / lag(price, 1) OVER w - 1) * 100', 'rppi_qoq_pct')},
       {r6('(price / lag(price, 4) OVER w - 1) * 100', 'rppi_yoy_pct')}
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period)""")

ORACLES["target"] = with_features("""
SELECT entity, period, round(rppi_qoq_pct * 1000000.0) / 1000000.0 AS rppi_qoq_pct,
       round(target * 1000000.0) / 1000000.0 AS target
FROM feat_all""")

ORACLES["feature_matrix"] = with_features(
    f"SELECT entity, period, {cols6(*FEATURE_COLS, 'target')} FROM feat"
)

from panelcast.operators.evaluation import z_value  # noqa: E402
from panelcast.plans.sqlgen import TRAIN_END_P, VAL_END_P, metrics_sql, pearson_sql, split_case, with_frame  # noqa: E402

Z90 = z_value(0.90)
MODELS = ["naive", "rolling_mean", "ensemble"]


def frame_sql(body: str) -> str:
    return with_frame(body, Z90)


ORACLES["panel_profile"] = with_panel("""
SELECT count(*) AS n_rows, count(DISTINCT entity) AS n_entities,
       min(period) AS min_period, max(period) AS max_period FROM panel""")

ORACLES["driver_quarterly"] = with_panel(f"SELECT series_id, period, {r6('value', 'value')} FROM quarterly")

ORACLES["drivers_aligned"] = with_panel(
    f"SELECT period, {cols6('cash_rate', 'cpi', 'unemployment_rate')} FROM drivers"
)

LABEL = "concat(CAST(period // 4 AS VARCHAR), 'Q', CAST(period % 4 + 1 AS VARCHAR))"
ORACLES["period_labels"] = with_panel(f"""
SELECT period, {LABEL} AS label,
       concat(CAST((period + 1) // 4 AS VARCHAR), 'Q', CAST((period + 1) % 4 + 1 AS VARCHAR)) AS next_label,
       period AS parsed
FROM (SELECT DISTINCT period FROM panel)""")

ORACLES["rolling_stats"] = with_features(
    f"SELECT entity, period, {cols6('rppi_qoq_pct', 'rolling_mean_4q', 'rolling_std_4q')} FROM feat_all"
)
ORACLES["lagged_changes"] = with_features(
    f"SELECT entity, period, {cols6('rppi_qoq_pct_lag1', 'rppi_yoy_pct_lag1')} FROM feat_all"
)
ORACLES["momentum"] = with_features(f"""
SELECT entity, period, {cols6('rppi_qoq_pct', 'momentum_streak', 'momentum_streak_lag1',
                              'price_accel', 'price_acceleration_lag1')} FROM feat_all""")
ORACLES["macro_features"] = with_features(f"""
SELECT entity, period, {cols6('cash_rate_delta', 'cash_rate_lag1', 'cash_rate_delta_lag1', 'cpi_yoy_pct',
                              'cpi_lag1', 'cpi_yoy_pct_lag1', 'unemp_delta', 'unemp_lag1', 'unemp_delta_lag1')}
FROM feat_all""")
ORACLES["rate_regime"] = with_features(
    f"SELECT entity, period, {cols6('cash_rate_lag1', 'rate_regime')} FROM feat_all"
)
ORACLES["seasonal"] = with_features(
    f"SELECT entity, period, quarter, {cols6('quarter_sin', 'quarter_cos')} FROM feat_all"
)
ORACLES["entity_dummies"] = with_features(
    "SELECT entity, period, " + ", ".join(dummy_name(v) for v in NATION_VOCAB) + " FROM feat_all"
)
ORACLES["rebase"] = with_panel(f"""
SELECT entity, period, {r6('price', 'price')},
       {r6('price / first_value(price) OVER (PARTITION BY entity ORDER BY period) * 100.0', 'price_rebased')}
FROM panel""")

_ACF_LAGS = ",\n         ".join(f"lag(rppi_qoq_pct, {k}) OVER w AS l{k}" for k in range(1, 9))
_ACF_CORR = ",\n         ".join(f"{pearson_sql('rppi_qoq_pct', f'l{k}')} AS c{k}" for k in range(1, 9))
_ACF_STACK = "\n  UNION ALL ".join(f"SELECT entity, n, {k} AS lag, c{k} AS acf FROM per_entity" for k in range(1, 9))
ORACLES["acf"] = with_features(f""",
lagged AS (
  SELECT entity, rppi_qoq_pct,
         {_ACF_LAGS}
  FROM feat_all WINDOW w AS (PARTITION BY entity ORDER BY period)
),
per_entity AS (
  SELECT entity, count(rppi_qoq_pct) AS n,
         {_ACF_CORR}
  FROM lagged GROUP BY entity
),
stacked AS (
  {_ACF_STACK}
)
SELECT CAST(lag AS INTEGER) AS lag, {r6('avg(acf)', 'acf')}, {r6('1.96 / sqrt(avg(n))', 'band')},
       count(acf) AS n_entities
FROM stacked GROUP BY lag""".replace("WITH ", "WITH ", 1)).replace("\n,\nlagged", ",\nlagged")

_INF_REQ = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS)
ORACLES["inference_matrix"] = with_features(
    f"SELECT entity, period, {cols6(*FEATURE_COLS)} FROM feat_all WHERE {_INF_REQ}"
)
ORACLES["latest_rows"] = with_features(f""",
inf AS (SELECT * FROM feat_all WHERE {_INF_REQ}),
last AS (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS rk FROM inf
)
SELECT entity, period, CAST(period + 1 AS INTEGER) AS predict_period, {cols6(*NUMERIC_FEATURES)}
FROM last WHERE rk = 1""").replace("\n,\ninf", ",\ninf")

ORACLES["splits"] = with_features(f"SELECT entity, period, {split_case()} AS split FROM feat")
ORACLES["split_sizes"] = with_features(f""",
s AS (SELECT period, {split_case()} AS split FROM feat)
SELECT coalesce(split, 'total') AS split, count(*) AS n, min(period) AS min_period, max(period) AS max_period
FROM s GROUP BY ROLLUP (split)""").replace("\n,\ns AS", ",\ns AS")

ORACLES["prediction_frame"] = frame_sql(
    f"SELECT entity, period, split, model, {cols6('y', 'pred', 'lo', 'hi')} FROM pf"
)
ORACLES["metrics_by_split"] = frame_sql(f"SELECT model, split, {metrics_sql()} FROM pf GROUP BY model, split")

_CMP = ",\n       ".join(
    metrics_sql(where=f"split = '{s}'", prefix=f"{s}_", names=("mae", "rmse", "r2", "directional_accuracy"))
    for s in ("train", "val", "test")
)
ORACLES["model_comparison"] = frame_sql(f"SELECT model, {_CMP} FROM pf GROUP BY model")

INSIDE = "CAST(y >= lo AND y <= hi AS DOUBLE)"
ORACLES["coverage"] = frame_sql(
    f"SELECT model, {r6(f'avg({INSIDE})', 'coverage')}, count(*) AS n FROM pf WHERE split = 'val' GROUP BY model"
)
ORACLES["leaderboard"] = frame_sql(f""",
per_model AS (
  SELECT model, {metrics_sql(names=('mae', 'rmse', 'r2', 'directional_accuracy'))},
         avg(abs(y - pred)) AS mae_raw,
         CASE WHEN max(abs(hi - lo)) > 0 THEN avg({INSIDE}) END AS cov
  FROM pf WHERE split = 'test' GROUP BY model
)
SELECT model, mae, rmse, r2, directional_accuracy, {r6('cov', 'coverage')},
       CAST(row_number() OVER (ORDER BY mae_raw, model) AS INTEGER) AS rank
FROM per_model""").replace("\n,\nper_model", ",\nper_model")

ORACLES["registry_ranking"] = frame_sql(f""",
entries AS (
  SELECT model AS name, {metrics_sql(names=('rmse',))} FROM pf WHERE split = 'test' GROUP BY model
  UNION ALL VALUES ('exact', 0.0), ('unrated', NULL)
)
SELECT name, '1' AS version, rmse AS test_rmse,
       CAST(row_number() OVER (ORDER BY rmse ASC NULLS LAST, name) AS INTEGER) AS rank, name = 'exact' AS is_best
FROM entries""").replace("\n,\nentries", ",\nentries")

ORACLES["period_means"] = frame_sql(f"""
SELECT model, period, {r6('avg(y)', 'mean_actual')}, {r6('avg(pred)', 'mean_pred')}, count(*) AS n
FROM pf WHERE split = 'test' GROUP BY model, period""")

ORACLES["interval_series"] = frame_sql(f"""
SELECT model, entity, period, {cols6('y', 'pred', 'lo', 'hi')}, CAST(y >= lo AND y <= hi AS INTEGER) AS inside
FROM pf WHERE split = 'val'
  AND (entity = 'NATION_1' OR NOT EXISTS (SELECT 1 FROM pf WHERE split = 'val' AND entity = 'NATION_1'))""")

_PIV = ", ".join(r6(f"avg(abs(y - pred)) FILTER (WHERE model = '{m}')", m) for m in MODELS)
ORACLES["entity_model_mae"] = frame_sql(f"SELECT entity, {_PIV} FROM pf WHERE split = 'test' GROUP BY entity")

ORACLES["residual_summary"] = frame_sql(f"""
SELECT model, {r6('avg(y - pred)', 'mu')}, {r6('stddev_pop(y - pred)', 'sigma')}, count(*) AS n
FROM pf WHERE split = 'test' GROUP BY model""")


def hist_sql(source: str, key: str) -> str:
    """Histogram body over ``source(<key>, v, nb)``; mirrors reports.histogram."""
    return f"""
hs AS (SELECT {key}, v, nb FROM {source} WHERE v IS NOT NULL),
st AS (SELECT {key}, min(v) AS lo, max(v) AS hi, count(*) AS total, max(nb) AS nb FROM hs GROUP BY {key}),
cnt AS (
  SELECT h.{key},
         CAST(CASE WHEN st.hi - st.lo > 0
                   THEN least(floor((h.v - st.lo) / (st.hi - st.lo) * st.nb), st.nb - 1) ELSE 0 END AS INTEGER) AS bin,
         count(*) AS c
  FROM hs h JOIN st ON h.{key} = st.{key} GROUP BY 1, 2
),
grid AS (SELECT st.*, CAST(unnest(range(0, st.nb)) AS INTEGER) AS bin FROM st)
SELECT g.{key}, g.bin,
       {r6('g.lo + g.bin * ((g.hi - g.lo) / g.nb)', 'bin_lo')},
       {r6('CASE WHEN g.bin = g.nb - 1 THEN g.hi ELSE g.lo + (g.bin + 1) * ((g.hi - g.lo) / g.nb) END', 'bin_hi')},
       CAST(coalesce(c.c, 0) AS BIGINT) AS count,
       {r6('coalesce(c.c, 0) / (g.total * CASE WHEN g.hi - g.lo > 0 THEN (g.hi - g.lo) / g.nb END)', 'density')}
FROM grid g LEFT JOIN cnt c ON g.{key} = c.{key} AND g.bin = c.bin"""


ORACLES["residual_histogram"] = frame_sql(f""",
rsrc AS (SELECT model, y - pred AS v, 25 AS nb FROM pf WHERE split = 'test'),
{hist_sql('rsrc', 'model').lstrip()}""").replace("\n,\nrsrc", ",\nrsrc")

PART = f"CASE WHEN period <= {VAL_END_P} THEN 'train_val' ELSE 'test' END"
ORACLES["target_histogram"] = with_features(f""",
tsrc AS (SELECT {PART} AS part, target AS v, CASE WHEN period <= {VAL_END_P} THEN 30 ELSE 15 END AS nb FROM feat),
{hist_sql('tsrc', 'part').lstrip()}""").replace("\n,\ntsrc", ",\ntsrc")

ORACLES["describe_target"] = with_features(f"""
SELECT {PART} AS part, count(target) AS count, round(avg(target), 3) AS mean, round(stddev_samp(target), 3) AS std,
       round(min(target), 3) AS min, round(quantile_cont(target, 0.25), 3) AS q25,
       round(quantile_cont(target, 0.5), 3) AS q50, round(quantile_cont(target, 0.75), 3) AS q75,
       round(max(target), 3) AS max
FROM feat GROUP BY 1""")

ORACLES["rate_target_fit"] = with_features(f"""
SELECT {r6('regr_slope(target, cash_rate)', 'slope')}, {r6('regr_intercept(target, cash_rate)', 'intercept')},
       {r6(pearson_sql('cash_rate', 'target'), 'r')}, CAST(regr_count(target, cash_rate) AS BIGINT) AS n
FROM feat WHERE period <= {TRAIN_END_P}""")

ORACLES["seasonal_target"] = with_features(f"""
SELECT quarter, {r6('avg(target)', 'mean')}, {r6('stddev_samp(target)', 'std')}, count(target) AS n
FROM feat GROUP BY quarter""")

def _ftc_row(c: str) -> str:
    r = pearson_sql(c, "target")
    return (f"SELECT '{c}' AS feature, {r6(r, 'corr')}, {r6(f'abs({r})', 'abs_corr')} "
            f"FROM feat WHERE period <= {TRAIN_END_P}")


_FTC = "\nUNION ALL ".join(_ftc_row(c) for c in FEATURE_COLS)
ORACLES["feature_target_corr"] = with_features(_FTC)

_PAIRS = [(a, b) for i, a in enumerate(NUMERIC_FEATURES) for b in NUMERIC_FEATURES[i:]]
_CM_AGG = ",\n         ".join(f"{pearson_sql(a, b)} AS c{i}" for i, (a, b) in enumerate(_PAIRS))
_CM_ROWS = []
for _i, (_a, _b) in enumerate(_PAIRS):
    _v = f"c{_i}" if _a != _b else f"CASE WHEN c{_i} IS NOT NULL THEN 1.0 END"
    _CM_ROWS.append(f"SELECT '{_a}' AS feature_a, '{_b}' AS feature_b, {r6(_v, 'corr')} FROM cm")
    if _a != _b:
        _CM_ROWS.append(f"SELECT '{_b}', '{_a}', {r6(_v, 'corr')} FROM cm")
ORACLES["correlation_matrix"] = with_features(f""",
cm AS (SELECT {_CM_AGG} FROM feat)
{chr(10).join(('UNION ALL ' if k else '') + r for k, r in enumerate(_CM_ROWS))}""").replace("\n,\ncm AS", ",\ncm AS")

ORACLES["driver_ranges"] = with_features(f"""
SELECT {split_case()} AS split,
       {', '.join(r6(f'{fn}({d})', f'{d}_{fn}') for d in ('cash_rate', 'cpi', 'unemployment_rate') for fn in ('min', 'max'))}
FROM feat GROUP BY 1""")

ORACLES["target_by_entity"] = with_features(f"""
SELECT entity, {r6('min(target)', 'target_min')}, {r6('max(target)', 'target_max')}, {r6('avg(target)', 'target_mean')}
FROM feat GROUP BY entity""")

ORACLES["residual_spread"] = frame_sql(f""",
rr AS (SELECT model, entity, y - pred AS r FROM pf WHERE split = 'val'),
box AS (
  SELECT model, entity, stddev_samp(r) AS std, quantile_cont(r, 0.25) AS q1,
         quantile_cont(r, 0.5) AS median, quantile_cont(r, 0.75) AS q3
  FROM rr GROUP BY model, entity
),
fence AS (
  SELECT rr.model, rr.entity, min(r) AS whisker_lo, max(r) AS whisker_hi
  FROM rr JOIN box ON rr.model = box.model AND rr.entity = box.entity
  WHERE r >= q1 - 1.5 * (q3 - q1) AND r <= q3 + 1.5 * (q3 - q1)
  GROUP BY rr.model, rr.entity
)
SELECT b.model, b.entity, {cols6('std', 'q1', 'median', 'q3', 'whisker_lo', 'whisker_hi')}
FROM box b LEFT JOIN fence f ON b.model = f.model AND b.entity = f.entity""").replace("\n,\nrr AS", ",\nrr AS")

BAND = "CASE WHEN {x} > 0.1 THEN 'up' WHEN {x} < -0.1 THEN 'down' ELSE 'flat' END"
ORACLES["direction_confusion"] = frame_sql(f""",
lab AS (SELECT model, {BAND.format(x='y')} AS actual, {BAND.format(x='pred')} AS predicted FROM pf WHERE split = 'val')
SELECT model, actual, count(*) FILTER (WHERE predicted = 'down') AS down,
       count(*) FILTER (WHERE predicted = 'flat') AS flat, count(*) FILTER (WHERE predicted = 'up') AS up
FROM lab GROUP BY model, actual""").replace("\n,\nlab AS", ",\nlab AS")

ORACLES["direction_accuracy"] = frame_sql(f"""
SELECT model, {r6(f"avg(CAST(({BAND.format(x='y')}) = ({BAND.format(x='pred')}) AS DOUBLE))", 'accuracy')}, count(*) AS n
FROM pf WHERE split = 'val' GROUP BY model""")

_DPIV = ", ".join(r6(f"avg(CAST(sign(pred) = sign(y) AS DOUBLE)) FILTER (WHERE model = '{m}')", m) for m in MODELS)
ORACLES["direction_by_entity"] = frame_sql(f"SELECT entity, {_DPIV} FROM pf WHERE split = 'val' GROUP BY entity")

ORACLES["residual_series"] = frame_sql(f"""
SELECT model, split, entity, period, {r6('y - pred', 'residual')} FROM pf WHERE split IN ('val', 'test')""")

ORACLES["pred_actual_bounds"] = frame_sql(f"""
SELECT model, {r6('1.1 * greatest(max(abs(y)), max(abs(pred)))', 'bound')}, count(*) AS n
FROM pf WHERE split = 'test' AND model <> 'ensemble' GROUP BY model""")

# Walk-forward plan of the testdata panel.
CV_SPLITS, CV_MIN_TRAIN, CV_VAL = 3, 8, 4
FOLD_CTES = f""",
pp AS (SELECT period, CAST(row_number() OVER (ORDER BY period) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT period FROM feat)),
tt AS (SELECT count(*) AS total FROM pp),
prm AS (SELECT total - {CV_MIN_TRAIN} - {CV_VAL} AS spare,
               greatest(1, (total - {CV_MIN_TRAIN} - {CV_VAL}) // {CV_SPLITS}) AS step FROM tt),
folds AS (
  SELECT CAST(n.fold AS INTEGER) AS fold, a.period AS train_end, b.period AS val_end
  FROM (SELECT unnest(range({CV_SPLITS})) AS fold) n
  JOIN prm ON n.fold * prm.step < prm.spare
  JOIN pp a ON a.idx = {CV_MIN_TRAIN} + n.fold * prm.step - 1
  JOIN pp b ON b.idx = {CV_MIN_TRAIN} + n.fold * prm.step + {CV_VAL} - 1
),
cvlong AS (
  SELECT f.fold, 'naive' AS model, s.target AS y, s.rppi_qoq_pct_lag1 AS pred
  FROM feat s JOIN folds f ON s.period > f.train_end AND s.period <= f.val_end
  UNION ALL
  SELECT f.fold, 'rolling_mean', s.target, s.rolling_mean_4q
  FROM feat s JOIN folds f ON s.period > f.train_end AND s.period <= f.val_end
),
cvm AS (
  SELECT fold, model, avg(abs(y - pred)) AS mae,
         CASE WHEN var_pop(y) * count(y) > 0 THEN 1.0 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(y)) ELSE 0.0 END AS r2,
         avg(CAST(sign(pred) = sign(y) AS DOUBLE)) AS directional_accuracy
  FROM cvlong GROUP BY fold, model
)"""
ORACLES["walk_forward_folds"] = with_features(
    FOLD_CTES + "\nSELECT fold, CAST(train_end AS INTEGER) AS train_end, CAST(val_end AS INTEGER) AS val_end FROM folds"
).replace("\n,\npp AS", ",\npp AS")
ORACLES["cv_fold_metrics"] = with_features(FOLD_CTES + f"""
SELECT f.fold, 'naive' AS model, {metrics_sql(pred='s.rppi_qoq_pct_lag1', y='s.target')}
FROM feat s JOIN folds f ON s.period > f.train_end AND s.period <= f.val_end GROUP BY f.fold
UNION ALL
SELECT f.fold, 'rolling_mean' AS model, {metrics_sql(pred='s.rolling_mean_4q', y='s.target')}
FROM feat s JOIN folds f ON s.period > f.train_end AND s.period <= f.val_end GROUP BY f.fold""").replace("\n,\npp AS", ",\npp AS")
ORACLES["cv_summary"] = with_features(FOLD_CTES + f"""
SELECT model, {r6('avg(mae)', 'mae_mean')}, {r6('stddev_pop(mae)', 'mae_std')},
       {r6('avg(r2)', 'r2_mean')}, {r6('stddev_pop(r2)', 'r2_std')},
       {r6('avg(directional_accuracy)', 'directional_accuracy_mean')},
       {r6('stddev_pop(directional_accuracy)', 'directional_accuracy_std')}, count(*) AS n_folds
FROM cvm GROUP BY model""").replace("\n,\npp AS", ",\npp AS")

# ---------------------------------------------------------------------------
# Requests, links, request log, stream
# ---------------------------------------------------------------------------

VR_CTE = """,
vr AS (
  SELECT entity || ':' || CAST(period AS VARCHAR) AS request_id, entity,
         CAST(period // 4 + 10 AS INTEGER) AS year, CAST(period % 4 + 1 AS INTEGER) AS quarter,
         price AS rppi_current, rppi_lag_1 AS rppi_lag1, rppi_lag_2 AS rppi_lag2, rppi_lag_4 AS rppi_lag4,
         rppi_qoq_pct AS rppi_qoq_pct_current, rppi_yoy_pct AS rppi_yoy_pct_current,
         rolling_mean_4q, rolling_std_4q, momentum_streak_lag1 AS momentum_streak,
         price_acceleration_lag1 AS price_acceleration, cash_rate, cash_rate_lag1 AS cash_rate_prev, cpi,
         lag(cpi, 4) OVER (PARTITION BY entity ORDER BY period) AS cpi_prev_year,
         unemployment_rate, unemp_lag1 AS unemployment_rate_prev
  FROM feat_all
)"""

ORACLES["vector_requests"] = with_features(VR_CTE + f"""
SELECT request_id, entity, year, quarter,
       {cols6('rppi_current', 'rppi_lag1', 'rppi_lag2', 'rppi_lag4', 'rppi_qoq_pct_current', 'rppi_yoy_pct_current',
              'rolling_mean_4q', 'rolling_std_4q', 'momentum_streak', 'price_acceleration', 'cash_rate',
              'cash_rate_prev', 'cpi', 'cpi_prev_year', 'unemployment_rate', 'unemployment_rate_prev')}
FROM vr""").replace("\n,\nvr AS", ",\nvr AS")

_KNOWN = ", ".join(f"'{v}'" for v in NATION_VOCAB)


def _fail(cond: str, msg: str) -> str:
    return f"CASE WHEN NOT coalesce({cond}, false) THEN '{msg}' END"


_VEC_RULES = [
    _fail(f"entity IN ({_KNOWN})", "entity: not a known entity"),
    _fail("quarter BETWEEN 1 AND 4", "quarter: must be 1, 2, 3 or 4"),
    _fail("year BETWEEN 2000 AND 2050", "year: must be between 2000 and 2050"),
    *[_fail(f"{f} > 0", f"{f}: must be greater than 0")
      for f in ("rppi_current", "rppi_lag1", "rppi_lag2", "rppi_lag4", "cpi", "cpi_prev_year")],
    *[_fail(f"{f} IS NOT NULL AND NOT isnan({f})", f"{f}: required")
      for f in ("rppi_qoq_pct_current", "rppi_yoy_pct_current", "rolling_mean_4q")],
    _fail("rolling_std_4q >= 0", "rolling_std_4q: must be at least 0"),
    *[_fail(f"{f} BETWEEN 0.0 AND 30.0", f"{f}: must be between 0 and 30") for f in ("cash_rate", "cash_rate_prev")],
    *[_fail(f"{f} BETWEEN 0.0 AND 100.0", f"{f}: must be between 0 and 100")
      for f in ("unemployment_rate", "unemployment_rate_prev")],
    _fail("(CASE WHEN rppi_lag4 <> 0 THEN rppi_current / rppi_lag4 END) > 0.5 "
          "AND (CASE WHEN rppi_lag4 <> 0 THEN rppi_current / rppi_lag4 END) < 2.0",
          "rppi_current: plausible values are 0.5 to 2.0 times rppi_lag4"),
]
ORACLES["vector_request_errors"] = with_features(VR_CTE + """,
errs AS (
  SELECT request_id, entity, list_filter([
    """ + ",\n    ".join(_VEC_RULES) + """
  ], lambda x: x IS NOT NULL) AS e FROM vr
)
SELECT request_id, entity, array_to_string(e, '; ') AS detail FROM errs WHERE len(e) > 0""").replace("\n,\nvr AS", ",\nvr AS")

ORACLES["batch_counts"] = with_features(VR_CTE + """,
errs AS (
  SELECT len(list_filter([
    """ + ",\n    ".join(_VEC_RULES) + """
  ], lambda x: x IS NOT NULL)) AS n FROM vr
)
SELECT count(*) FILTER (WHERE n = 0) AS success_count, count(*) FILTER (WHERE n > 0) AS error_count
FROM errs""").replace("\n,\nvr AS", ",\nvr AS")

_MAPPED = {
    "rppi_lag_1": "rppi_lag1", "rppi_lag_2": "rppi_lag2", "rppi_lag_4": "rppi_lag4",
    "rppi_qoq_pct_lag1": "rppi_qoq_pct_current", "rppi_yoy_pct_lag1": "rppi_yoy_pct_current",
    "rolling_mean_4q": "rolling_mean_4q", "rolling_std_4q": "rolling_std_4q",
    "momentum_streak_lag1": "coalesce(momentum_streak, 0)", "price_acceleration_lag1": "coalesce(price_acceleration, 0)",
    "cash_rate_lag1": "cash_rate_prev", "cash_rate_delta_lag1": "cash_rate - cash_rate_prev",
    "rate_regime": "CAST(CAST(cash_rate_prev >= 1 AS INTEGER) + CAST(cash_rate_prev >= 3 AS INTEGER) "
                   "+ CAST(cash_rate_prev >= 6 AS INTEGER) AS DOUBLE)",
    "cpi_lag1": "cpi", "cpi_yoy_pct_lag1": "(cpi / cpi_prev_year - 1) * 100",
    "unemp_lag1": "unemployment_rate_prev", "unemp_delta_lag1": "unemployment_rate - unemployment_rate_prev",
    "quarter_sin": "sin(2 * pi() * quarter / 4)", "quarter_cos": "cos(2 * pi() * quarter / 4)",
}
ORACLES["vector_features"] = with_features(VR_CTE + """,
ok AS (
  SELECT * FROM (SELECT *, list_filter([
    """ + ",\n    ".join(_VEC_RULES) + f"""
  ], lambda x: x IS NOT NULL) AS e FROM vr) WHERE len(e) = 0
)
SELECT request_id, {", ".join(r6(e, n) for n, e in _MAPPED.items())}, quarter,
       {", ".join(f"CAST(entity = '{v}' AS INTEGER) AS {dummy_name(v)}" for v in NATION_VOCAB)},
       CAST(year + quarter // 4 AS INTEGER) AS next_year, CAST(quarter % 4 + 1 AS INTEGER) AS next_quarter,
       round(rppi_qoq_pct_current, 4) AS predicted_qoq_pct_change,
       CASE WHEN rppi_qoq_pct_current > 0 THEN 'up' WHEN rppi_qoq_pct_current < 0 THEN 'down' ELSE 'flat' END AS direction,
       round(rppi_qoq_pct_current - 1, 4) AS lower, round(rppi_qoq_pct_current + 1, 4) AS upper,
       CAST(0.9 AS DOUBLE) AS confidence
FROM ok""").replace("\n,\nvr AS", ",\nvr AS")

RAW_CTE = """,
rr0 AS (
  SELECT entity, period, price, cash_rate, cpi, unemployment_rate,
         CAST(period // 4 + 10 AS INTEGER) AS y, CAST(period % 4 + 1 AS INTEGER) AS q
  FROM panel
),
rawreq AS (
  SELECT entity || ':' || CAST(period AS VARCHAR) AS request_id, entity,
         list({'year': y, 'quarter': q, 'rppi_index': price}) OVER w AS r,
         list({'year': y, 'quarter': q, 'cash_rate': cash_rate, 'cpi': cpi, 'unemployment_rate': unemployment_rate}) OVER w AS m
  FROM rr0
  WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
),
faulty AS (
  SELECT request_id, entity, r,
         CASE WHEN p % 7 = 0 THEN m[1 : len(m) - 1]
              WHEN p % 11 = 0 THEN list_transform(m, lambda o: {'year': o.year + 1, 'quarter': o.quarter,
                'cash_rate': o.cash_rate, 'cpi': o.cpi, 'unemployment_rate': o.unemployment_rate})
              ELSE m END AS m
  FROM (SELECT *, CAST(split_part(request_id, ':', 2) AS INTEGER) AS p FROM rawreq)
)"""


def _all(lst: str, pred: str) -> str:
    return f"coalesce(list_bool_and(list_transform({lst}, lambda o: {pred})), true)"


_RAW_RULES = [
    _fail(f"entity IN ({_KNOWN})", "entity: not a known entity"),
    _fail("len(r) BETWEEN 6 AND 40", "rppi_history: must have 6 to 40 items"),
    _fail("len(m) BETWEEN 6 AND 40", "macro_history: must have 6 to 40 items"),
    _fail("len(r) = len(m)", "rppi_history and macro_history must have the same length"),
    _fail("len(r) = len(m) AND coalesce(list_bool_and(list_transform(range(1, len(r) + 1), "
          "lambda i: r[i].year = m[i].year AND r[i].quarter = m[i].quarter)), true)",
          "period mismatch between rppi_history and macro_history"),
    _fail(_all("r", "o.year BETWEEN 2000 AND 2050 AND o.quarter BETWEEN 1 AND 4"),
          "rppi_history: year must be between 2000 and 2050, quarter 1-4"),
    _fail(_all("m", "o.year BETWEEN 2000 AND 2050 AND o.quarter BETWEEN 1 AND 4"),
          "macro_history: year must be between 2000 and 2050, quarter 1-4"),
    _fail(_all("r", "o.rppi_index > 0"), "rppi_history: rppi_index must be greater than 0"),
    _fail(_all("m", "o.cash_rate BETWEEN 0.0 AND 30.0"), "macro_history: cash_rate must be between 0 and 30"),
    _fail(_all("m", "o.cpi > 0"), "macro_history: cpi must be greater than 0"),
    _fail(_all("m", "o.unemployment_rate BETWEEN 0.0 AND 100.0"),
          "macro_history: unemployment_rate must be between 0 and 100"),
]
ORACLES["raw_request_errors"] = with_panel(RAW_CTE + """,
errs AS (
  SELECT request_id, entity, list_filter([
    """ + ",\n    ".join(_RAW_RULES) + """
  ], lambda x: x IS NOT NULL) AS e FROM faulty
)
SELECT request_id, entity, array_to_string(e, '; ') AS detail FROM errs WHERE len(e) > 0""").replace("\n,\nrr0 AS", ",\nrr0 AS")

# a valid request holds consecutive quarters only, so none is too short for features
ORACLES["raw_scoring_errors"] = ORACLES["raw_request_errors"]

ORACLES["raw_panel"] = with_panel(f""",
pr AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS rn FROM panel)
SELECT a.entity || ':' || CAST(a.period AS VARCHAR) AS request_id, a.entity, CAST(b.period + 40 AS INTEGER) AS period,
       {r6('b.price', 'price')}, {r6('b.cash_rate', 'cash_rate')}, {r6('b.cpi', 'cpi')},
       {r6('b.unemployment_rate', 'unemployment_rate')}
FROM pr a JOIN pr b ON a.entity = b.entity AND b.rn BETWEEN a.rn - 5 AND a.rn""").replace("\n,\npr AS", ",\npr AS")

ORACLES["link_discovery"] = r"""
WITH hrefs AS (
  SELECT page_id, url,
         list_filter(
           regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>|<!--.*?-->', '', 'g'),
                              '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1),
           lambda h: regexp_matches(h, '(?i)tion|ment'))[1] AS first
  FROM pages
)
SELECT page_id, url,
       CASE WHEN starts_with(first, 'http') THEN first
            ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || first END AS link
FROM hrefs"""

REQLOG = """
lg AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, '/api/' || event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, value / 100.0 AS latency
  FROM events
)"""
ORACLES["request_counts"] = "WITH" + REQLOG + "\nSELECT endpoint, status, count(*) AS requests FROM lg GROUP BY 1, 2"

_BOUNDS = [("0.05", 0.05), ("0.1", 0.1), ("0.25", 0.25), ("0.5", 0.5), ("1", 1.0), ("2.5", 2.5)]
_HIST_AGG = ", ".join(f"count(*) FILTER (WHERE latency <= {b!r}) AS b{i}" for i, (_, b) in enumerate(_BOUNDS))
_HIST_ROWS = "\nUNION ALL ".join(
    [f"SELECT endpoint, {r6('latency_sum', 'latency_sum')}, '{lab}' AS le, b{i} AS count FROM ha"
     for i, (lab, _) in enumerate(_BOUNDS)]
    + [f"SELECT endpoint, {r6('latency_sum', 'latency_sum')}, '+Inf' AS le, inf AS count FROM ha"]
)
ORACLES["latency_histogram"] = "WITH" + REQLOG + f""",
ha AS (
  SELECT endpoint, {_HIST_AGG}, count(*) AS inf, sum(latency) AS latency_sum
  FROM lg WHERE starts_with(endpoint, '/api/') GROUP BY endpoint
)
{_HIST_ROWS}"""

_LE = ", ".join(
    f"count(*) FILTER (WHERE latency <= {b!r}) AS le_{str(b).replace('.', '_')}" for _, b in _BOUNDS
)
ORACLES["stream_request_metrics"] = "WITH" + REQLOG + f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       endpoint, count(*) AS requests, count(*) FILTER (WHERE status = '500') AS errors,
       {r6('sum(latency)', 'latency_sum')}, {_LE}
FROM lg GROUP BY date_trunc('hour', ts), endpoint"""

ORACLES["ingest_round_trip"] = with_panel(
    f"SELECT entity, period, {cols6('price', 'cash_rate', 'cpi', 'unemployment_rate')} FROM panel", level="region"
)
ORACLES["rate_csv_series"] = with_panel(
    f"SELECT obs_date, {r6('value', 'value')} FROM obs WHERE series_id = 'cash_rate' AND value IS NOT NULL"
)

SQRT_2PI = math.sqrt(2 * math.pi)
ORACLES["target_kde"] = with_features(f""",
kd AS (SELECT {PART} AS part, target AS v FROM feat WHERE target IS NOT NULL),
ks AS (
  SELECT part, count(*) AS n, stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h, min(v) AS lo, max(v) AS hi
  FROM kd GROUP BY part
),
kg AS (SELECT part, n, h, lo - 3.0 * h AS a, hi + 3.0 * h AS b, CAST(unnest(range(0, 200)) AS INTEGER) AS g FROM ks),
kt AS (
  SELECT kg.part, kg.g, kg.n, kg.a, kg.b,
         sum(CASE WHEN kg.h > 0 THEN exp(-0.5 * ((kg.a + kg.g * ((kg.b - kg.a) / 199) - kd.v) / kg.h)
                                            * ((kg.a + kg.g * ((kg.b - kg.a) / 199) - kd.v) / kg.h))
                                     / (kg.h * {SQRT_2PI!r}) END) AS k
  FROM kg JOIN kd ON kg.part = kd.part
  GROUP BY kg.part, kg.g, kg.n, kg.a, kg.b
)
SELECT part, g AS point, {r6('a + g * ((b - a) / 199)', 'x')}, {r6('k / n', 'density')} FROM kt""").replace("\n,\nkd AS", ",\nkd AS")

ORACLES["sheet_headers"] = """
WITH r AS (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) AS k, count(*) OVER () AS n FROM region),
h AS (
  SELECT 'rppi' AS file, k AS col_idx, 'Price Index ;  ' || r_name || ' ;' AS raw FROM r
  UNION ALL SELECT 'rppi', k + n, 'Percentage Change from Previous Period ;  ' || r_name || ' ;' FROM r
  UNION ALL SELECT 'rppi', 2 * count(*) + 1, 'Price Index ;  Weighted average of all regions ;' FROM r
  UNION ALL VALUES ('cpi', 1, 'Index Numbers ;  Food ;'), ('cpi', 2, 'Index Numbers ;  All groups CPI, national ;'),
    ('labour', 1, 'Employed total ;  Persons ;'), ('labour', 2, 'Unemployment rate ;  Persons ;  Trend ;'),
    ('labour', 3, 'Unemployment rate ;  Persons ;  Seasonally Adjusted ;')
),
c AS (
  SELECT *, list_filter(list_transform(string_split(raw, ';'), lambda t: trim(t)), lambda t: t <> '')[-1] AS name FROM h
),
s AS (SELECT *, row_number() OVER (PARTITION BY file, name ORDER BY col_idx) - 1 AS again FROM c)
SELECT file, CAST(col_idx AS INTEGER) AS col_idx, raw,
       name || CASE WHEN again > 0 THEN '_' || again ELSE '' END AS series,
       CASE WHEN file = 'rppi' AND raw LIKE 'Price Index%' THEN 'price'
            WHEN file = 'cpi' AND raw LIKE '%All groups CPI%' THEN 'cpi'
            WHEN file = 'labour' AND raw ILIKE '%unemployment rate%seasonally%' THEN 'unemployment' END AS role
FROM s"""

# ---------------------------------------------------------------------------
# Ridge: normal equations solved by Gauss-Jordan elimination (the matrices are
# positive definite, so no pivoting is needed), alpha by contiguous 5-fold CV
# ---------------------------------------------------------------------------

_D = len(FEATURE_COLS)
RIDGE_CTES = f"""
sp AS (SELECT *, {split_case()} AS split FROM feat),
allx AS (
  SELECT entity, period, split, target AS y,
         list_value({", ".join(f"CAST({c} AS DOUBLE)" for c in FEATURE_COLS)}) AS x FROM sp
),
tr AS (
  SELECT x, y, idx, CASE WHEN idx < r * (q + 1) THEN idx // (q + 1) ELSE r + (idx - r * (q + 1)) // q END AS fold
  FROM (SELECT x, y, row_number() OVER (ORDER BY entity, period) - 1 AS idx,
               count(*) OVER () // 5 AS q, count(*) OVER () % 5 AS r FROM allx WHERE split = 'train')
),
one AS (SELECT j, avg(x[j]) AS mu, stddev_pop(x[j]) AS sd FROM tr, range(1, {_D + 1}) t(j) GROUP BY j),
ms AS (SELECT list(mu ORDER BY j) AS mu, list(CASE WHEN sd > 0 THEN sd ELSE 1.0 END ORDER BY j) AS sd FROM one),
zx AS (
  SELECT entity, period, split, y, list_transform(x, lambda e, j: (e - mu[j]) / sd[j]) AS z FROM allx, ms
),
zt AS (SELECT fold, y, list_transform(x, lambda e, j: (e - mu[j]) / sd[j]) AS z FROM tr, ms),
gr AS (
  SELECT fold, i, j, sum(r[i] * r[j]) AS s
  FROM (SELECT fold, list_concat([1.0], z, [y]) AS r FROM zt), range(1, {_D + 3}) a(i), range(1, {_D + 3}) b(j)
  GROUP BY fold, i, j
),
tot AS (SELECT i, j, sum(s) AS s FROM gr GROUP BY i, j),
kept AS (
  SELECT gr.fold AS held, i, j, tot.s - gr.s AS s FROM gr JOIN tot USING (i, j)
  UNION ALL SELECT -1, i, j, s FROM tot
),
gm AS (
  SELECT held, list(g ORDER BY i) AS g FROM (SELECT held, i, list(s ORDER BY j) AS g FROM kept GROUP BY held, i) GROUP BY held
),
al AS (SELECT unnest([0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]) AS alpha, unnest(range(6)) AS pos),
gj(held, alpha, pos, k, m) AS (
  SELECT held, CAST(alpha AS DOUBLE), pos, CAST(1 AS BIGINT),
         list_transform(range(1, {_D + 1}), lambda i: list_concat(
           list_transform(range(1, {_D + 1}), lambda j: g[i + 1][j + 1] - g[1][i + 1] * g[1][j + 1] / g[1][1]
             + CASE WHEN i = j THEN CAST(alpha AS DOUBLE) ELSE 0.0 END),
           [g[i + 1][{_D + 2}] - g[1][i + 1] * g[1][{_D + 2}] / g[1][1]]))
  FROM gm, al
  UNION ALL
  SELECT held, alpha, pos, k + 1,
         list_transform(m, lambda line, i: CASE WHEN i = k THEN p
           ELSE list_transform(line, lambda e, j: e - line[k] * p[j]) END)
  FROM (SELECT *, list_transform(m[k], lambda e: e / m[k][k]) AS p FROM gj WHERE k <= {_D})
),
sol AS (
  SELECT held, alpha, pos, w,
         g[1][{_D + 2}] / g[1][1] - list_sum(list_transform(w, lambda e, j: e * g[1][j + 1] / g[1][1])) AS b0
  FROM (SELECT held, alpha, pos, list_transform(m, lambda line: line[{_D + 1}]) AS w FROM gj WHERE k = {_D + 1})
  JOIN gm USING (held)
),
r2 AS (
  SELECT alpha, pos, held, 1 - sum((y - b0 - list_dot_product(w, z)) ** 2) / (var_pop(y) * count(*)) AS r2
  FROM zt JOIN sol ON sol.held = zt.fold GROUP BY alpha, pos, held
),
chosen AS (SELECT alpha FROM r2 GROUP BY alpha, pos ORDER BY avg(r2) DESC, pos LIMIT 1),
rm AS (SELECT w, b0 FROM sol JOIN chosen USING (alpha) WHERE held = -1),
rp AS (SELECT entity, period, split, y, z, b0 + list_dot_product(w, z) AS pred FROM zx, rm),
names AS (SELECT unnest({FEATURE_COLS!r}) AS feature, unnest(range(1, {_D + 1})) AS j)"""


def with_ridge(body: str) -> str:
    return with_features("," + RIDGE_CTES + body).replace("\n,\nsp AS", ",\nsp AS").replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES["ridge_predictions"] = with_ridge(f"""
SELECT 'ridge' AS model, split, entity, period, {cols6('y', 'pred')},
       {r6('pred - half', 'lo')}, {r6('pred + half', 'hi')}
FROM rp, (SELECT {Z90!r} * stddev_pop(y - pred) AS half FROM rp WHERE split = 'val')""")

ORACLES["ridge_importance"] = with_ridge(f"""
SELECT CAST(row_number() OVER (ORDER BY v DESC, feature) AS INTEGER) AS rank, feature,
       {r6('v', 'importance')}, {r6('v / max(v) OVER ()', 'relative')}
FROM (SELECT feature, abs(w[j]) AS v FROM names, rm) ORDER BY v DESC, feature LIMIT 15""")

ORACLES["ridge_attribution"] = with_ridge(f"""
SELECT feature, {r6('v', 'mean_abs_attribution')}
FROM (SELECT feature, avg(abs(w[j] * z[j])) AS v FROM names, rm, rp WHERE split = 'test' GROUP BY feature)
ORDER BY v DESC, feature LIMIT 15""")


# walk-forward folds of the ridge: the same solution with each fold's own split
_FOLD_ONLY = FOLD_CTES[: FOLD_CTES.index("cvlong AS (")].rstrip().rstrip(",").lstrip(",")


def _ridge_fold(fold: int) -> str:
    """(fold, y, pred) of one fold's validation rows."""
    split = (f"CASE WHEN period <= (SELECT train_end FROM folds WHERE fold = {fold}) THEN 'train' "
             f"WHEN period <= (SELECT val_end FROM folds WHERE fold = {fold}) THEN 'val' END")
    ctes = RIDGE_CTES.replace(split_case(), split)
    return (with_features("," + _FOLD_ONLY + "," + ctes).replace("WITH ", "WITH RECURSIVE ", 1)
            + f"\nSELECT CAST({fold} AS INTEGER) AS fold, y, pred FROM rp WHERE split = 'val' "
              f"AND EXISTS (SELECT 1 FROM folds WHERE fold = {fold})")


_RIDGE_FOLDS = "\nUNION ALL\n".join(f"SELECT * FROM ({_ridge_fold(i)})" for i in range(CV_SPLITS))
ORACLES["ridge_walk_forward"] = f"""
SELECT fold, 'ridge' AS model, {metrics_sql()}
FROM ({_RIDGE_FOLDS}) GROUP BY fold"""
ORACLES["ridge_cv_summary"] = f"""
WITH m AS (
  SELECT fold, avg(abs(y - pred)) AS mae,
         CASE WHEN var_pop(y) * count(y) > 0 THEN 1.0 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(y)) ELSE 0.0 END AS r2,
         avg(CAST(sign(pred) = sign(y) AS DOUBLE)) AS directional_accuracy
  FROM ({_RIDGE_FOLDS}) GROUP BY fold
)
SELECT 'ridge' AS model, {r6('avg(mae)', 'mae_mean')}, {r6('stddev_pop(mae)', 'mae_std')},
       {r6('avg(r2)', 'r2_mean')}, {r6('stddev_pop(r2)', 'r2_std')},
       {r6('avg(directional_accuracy)', 'directional_accuracy_mean')},
       {r6('stddev_pop(directional_accuracy)', 'directional_accuracy_std')}, count(*) AS n_folds
FROM m"""

ORACLES["panel_union"] = " UNION ALL ".join(
    f"SELECT * FROM ({with_panel('SELECT ' + repr(level) + ' AS level, entity, period, ' + cols6('price', 'cash_rate', 'cpi', 'unemployment_rate') + ' FROM panel', level)})"
    for level in ("nation", "region"))

# ---------------------------------------------------------------------------
# Scoring with the best of two ridges: the one chosen by CV and the stiffest one
# ---------------------------------------------------------------------------

_INPUT = {**_MAPPED, "quarter": "quarter", **{dummy_name(v): f"entity = '{v}'" for v in NATION_VOCAB}}
_SERVING = """,
cand AS (
  SELECT 'ridge' AS name, w, b0 FROM rm
  UNION ALL SELECT 'ridge_stiff', w, b0 FROM sol WHERE held = -1 AND alpha = 1000.0
),
rated AS (
  SELECT name, sqrt(avg((y - b0 - list_dot_product(w, z)) ** 2) FILTER (WHERE split = 'test')) AS rmse,
         stddev_pop(y - b0 - list_dot_product(w, z)) FILTER (WHERE split = 'val') AS sd
  FROM cand, zx GROUP BY name
),
serving AS (SELECT name, sd, w, b0 FROM rated JOIN cand USING (name) ORDER BY rmse, name LIMIT 1)"""


def _vector_x() -> str:
    return ", ".join(f"CAST({_INPUT[c]} AS DOUBLE)" for c in FEATURE_COLS)


def _valid(source: str, rules: list[str], name: str) -> str:
    return (f",\n{name} AS (SELECT * FROM (SELECT *, list_filter([\n    " + ",\n    ".join(rules)
            + f"\n  ], lambda x: x IS NOT NULL) AS e FROM {source}) WHERE len(e) = 0)")


def _scored(rows: str) -> str:
    """(request_id, entity, year, quarter, z, pred) of prepared inputs ``(.., x)``."""
    return f""",
inputs AS ({rows}),
answered AS (
  SELECT request_id, entity, year, quarter, name, sd, w, b0, z, b0 + list_dot_product(w, z) AS pred
  FROM (SELECT inputs.*, list_transform(x, lambda e, j: (e - mu[j]) / sd[j]) AS z FROM inputs, ms), serving
)"""


_ANSWER = f"""
SELECT request_id, entity, year, quarter, round(pred, 4) AS predicted_qoq_pct_change,
       CASE WHEN pred > 0 THEN 'up' WHEN pred < 0 THEN 'down' ELSE 'flat' END AS direction,
       round(pred - {Z90!r} * sd, 4) AS lower, round(pred + {Z90!r} * sd, 4) AS upper,
       CAST(0.9 AS DOUBLE) AS confidence, name AS model_name, '1' AS model_version"""

_EXPLAINED = f"""
SELECT request_id, entity, feature, {r6('w[j] * z[j]', 'contribution')}, round(b0, 4) AS base_value,
       round(pred, 4) AS predicted_qoq_pct_change, CAST(0.0 AS DOUBLE) AS gap"""

_VECTOR_ROWS = f"""
  SELECT request_id, entity, CAST(year + quarter // 4 AS INTEGER) AS year, CAST(quarter % 4 + 1 AS INTEGER) AS quarter,
         [{_vector_x()}] AS x FROM okvec"""


def with_vector_scores(body: str) -> str:
    ctes = RIDGE_CTES + _SERVING + VR_CTE + _valid("vr", _VEC_RULES, "okvec") + _scored(_VECTOR_ROWS)
    return with_features("," + ctes + body).replace("\n,\nsp AS", ",\nsp AS").replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES["score_vector_requests"] = with_vector_scores(_ANSWER + " FROM answered")
ORACLES["explain_vector_requests"] = with_vector_scores(_EXPLAINED + " FROM answered, names")
ORACLES["stream_scoring"] = with_vector_scores(
    _ANSWER + ", CAST(NULL AS VARCHAR) AS detail FROM answered UNION ALL BY NAME SELECT * FROM ("
    + "SELECT request_id, entity, array_to_string(e, '; ') AS detail FROM (SELECT *, list_filter([\n    "
    + ",\n    ".join(_VEC_RULES) + "\n  ], lambda x: x IS NOT NULL) AS e FROM vr) WHERE len(e) > 0)")

# raw histories: the same feature CTEs over the rows of each request
_RAW_FEATURES = re.sub(r"\b(f[1-4]|feat_all|feat)\b", r"raw_\1", feature_ctes()).replace("FROM panel", "FROM rawpanel")
_RAW_INPUT = {**{c: c for c in FEATURE_COLS},
              **{dummy_name(v): f"split_part(entity, ':', 1) = '{v}'" for v in NATION_VOCAB}}
_RAW_X = ", ".join(f"CAST({_RAW_INPUT[c]} AS DOUBLE)" for c in FEATURE_COLS)
_RAW_ROWS = f"""
  SELECT entity AS request_id, split_part(entity, ':', 1) AS entity, CAST((period + 1) // 4 AS INTEGER) AS year,
         CAST((period + 1) % 4 + 1 AS INTEGER) AS quarter, [{_RAW_X}] AS x
  FROM raw_feat_all WHERE {" AND ".join(f"{c} IS NOT NULL" for c in NUMERIC_FEATURES)}
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1"""


def with_raw_scores(body: str) -> str:
    rows = """,
rawrows AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS rn FROM panel),
rawpanel AS (
  SELECT a.entity || ':' || CAST(a.period AS VARCHAR) AS entity, CAST(b.period + 40 AS INTEGER) AS period,
         b.price, b.cash_rate, b.cpi, b.unemployment_rate
  FROM rawrows a JOIN rawrows b ON a.entity = b.entity AND b.rn BETWEEN a.rn - 5 AND a.rn
  WHERE a.entity || ':' || CAST(a.period AS VARCHAR) IN (SELECT request_id FROM okraw)
),"""
    ctes = (RIDGE_CTES + _SERVING + RAW_CTE + _valid("rawreq", _RAW_RULES, "okraw") + rows + _RAW_FEATURES
            + _scored(_RAW_ROWS))
    return with_features("," + ctes + body).replace("\n,\nsp AS", ",\nsp AS").replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES["score_raw_requests"] = with_raw_scores(_ANSWER + " FROM answered")
ORACLES["explain_raw_requests"] = with_raw_scores(
    _EXPLAINED + ", CAST(year * 4 + quarter - 1 AS INTEGER) AS predict_period FROM answered, names")
ORACLES["ridge_explain"] = with_ridge(f"""
SELECT entity, period, feature, {r6('w[j] * z[j]', 'contribution')}, {r6('b0', 'base_value')}, {r6('pred', 'pred')}
FROM rp, rm, names WHERE split = 'test'""")

# ---------------------------------------------------------------------------
# Many entities: ridge with an effect per customer, eliminated from the normal equations
# ---------------------------------------------------------------------------

ORACLES["entity_index"] = with_panel(
    "SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS idx FROM (SELECT DISTINCT entity FROM panel)", "customer")

_N = len(NUMERIC_FEATURES)
ORACLES["customer_ridge"] = with_features(f""",
sp AS (SELECT *, {split_case()} AS split FROM feat),
allx AS (
  SELECT entity, period, split, target AS y,
         list_value({", ".join(f"CAST({c} AS DOUBLE)" for c in NUMERIC_FEATURES)}) AS x FROM sp
),
one AS (
  SELECT j, avg(x[j]) AS mu, stddev_pop(x[j]) AS sd FROM allx, range(1, {_N + 1}) t(j) WHERE split = 'train' GROUP BY j
),
ms AS (SELECT list(mu ORDER BY j) AS mu, list(CASE WHEN sd > 0 THEN sd ELSE 1.0 END ORDER BY j) AS sd FROM one),
zx AS (
  SELECT entity, period, split, y, list_concat([1.0], list_transform(x, lambda e, j: (e - mu[j]) / sd[j])) AS z FROM allx, ms
),
zt AS (SELECT entity, list_concat(z, [y]) AS r FROM zx WHERE split = 'train'),
gr AS (
  SELECT i, j, sum(r[i] * r[j]) AS s FROM zt, range(1, {_N + 3}) a(i), range(1, {_N + 3}) b(j) GROUP BY i, j
),
ev AS (
  SELECT entity, max(g) FILTER (WHERE i = 1) AS n, list(g ORDER BY i) AS g
  FROM (SELECT entity, i, sum(r[i]) AS g FROM zt, range(1, {_N + 3}) a(i) GROUP BY entity, i) GROUP BY entity
),
sh AS (
  SELECT entity, n, g, CASE WHEN n < tot THEN n / tot * (1 - n / tot) ELSE 1.0 END AS s2 FROM ev, (SELECT count(*) AS tot FROM zt)
),
al AS (SELECT CAST(unnest([0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]) AS DOUBLE) AS alpha, unnest(range(6)) AS pos),
tk AS (
  SELECT alpha, pos, i, j, sum(g[i] * g[j] / (n + alpha * s2)) AS s
  FROM sh, al, range(1, {_N + 3}) a(i), range(1, {_N + 3}) b(j) GROUP BY alpha, pos, i, j
),
gm AS (
  SELECT alpha, pos, list(line ORDER BY i) AS g
  FROM (SELECT alpha, pos, i, list(gr.s - tk.s ORDER BY j) AS line FROM gr JOIN tk USING (i, j) GROUP BY alpha, pos, i)
  GROUP BY alpha, pos
),
gj(alpha, pos, k, m) AS (
  SELECT alpha, pos, CAST(1 AS BIGINT),
         list_transform(range(1, {_N + 2}), lambda i: list_concat(
           list_transform(range(1, {_N + 2}), lambda j: g[i][j] + CASE WHEN i = j AND i > 1 THEN alpha ELSE 0.0 END),
           [g[i][{_N + 2}]]))
  FROM gm
  UNION ALL
  SELECT alpha, pos, k + 1,
         list_transform(m, lambda line, i: CASE WHEN i = k THEN p
           ELSE list_transform(line, lambda e, j: e - line[k] * p[j]) END)
  FROM (SELECT *, list_transform(m[k], lambda e: e / m[k][k]) AS p FROM gj WHERE k <= {_N + 1})
),
sol AS (SELECT alpha, pos, list_transform(m, lambda line: line[{_N + 2}]) AS w FROM gj WHERE k = {_N + 2}),
ef AS (
  SELECT pos, entity, (g[{_N + 2}] - list_dot_product(w, g[1 : {_N + 1}])) / (n + alpha * s2) AS effect FROM sh, sol
),
pr AS (
  SELECT sol.pos, zx.entity, period, split, y, list_dot_product(w, z) + coalesce(effect, 0.0) AS pred,
         coalesce(effect, 0.0) AS effect
  FROM zx CROSS JOIN sol LEFT JOIN ef ON ef.entity = zx.entity AND ef.pos = sol.pos
),
best AS (SELECT pos FROM pr WHERE split = 'val' GROUP BY pos ORDER BY sqrt(avg((y - pred) ** 2)), pos LIMIT 1)
SELECT entity, period, split, {cols6('y', 'pred', 'effect')} FROM pr JOIN best USING (pos)""",
    vocab=[], level="customer").replace("\n,\nsp AS", ",\nsp AS").replace("WITH ", "WITH RECURSIVE ", 1)

ORACLES["stored_panel_features"] = ORACLES["feature_matrix"]
