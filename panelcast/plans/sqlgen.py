"""ANSI SQL twins of the registered queries (checked with DuckDB).

The SQL is written independently of the DataFrame code and only shares the
column contract. Doubles are presented as ``round(x * 1e6) / 1e6`` on both
sides: the same IEEE operations in both engines, so equal inputs give
bit-equal outputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from panelcast.operators.features import NUMERIC_FEATURES, dummy_name

# Rule for the testdata nation names (NATION_0 ... NATION_24, key order).
NATION_VOCAB = [f"NATION_{i}" for i in range(25)]


def r6(expr: str, alias: str) -> str:
    return f"round(({expr}) * 1000000.0) / 1000000.0 AS {alias}"


def period_expr(ts: str) -> str:
    return f"CAST(year({ts}) * 4 + quarter({ts}) - 1 AS INTEGER)"


def panel_ctes(level: str = "nation") -> str:
    """CTEs cust, prices, daily, months, obs, quarterly, drivers, panel."""
    if level == "nation":
        cust = """SELECT c.c_custkey, n.n_name AS entity
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
    elif level == "customer":
        cust = "SELECT c_custkey, 'CUSTOMER_' || CAST(c_custkey AS VARCHAR) AS entity FROM customer"
    else:
        cust = """SELECT c.c_custkey, r.r_name AS entity
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""
    return f"""
cust AS (
  {cust}
),
prices AS (
  SELECT cu.entity, {period_expr('o.o_orderdate')} AS period,
         CAST(SUM(CAST(floor(o.o_totalprice * 100.0 + 0.5) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100.0 AS price,
         COUNT(*) AS n_orders
  FROM orders o JOIN cust cu ON o.o_custkey = cu.c_custkey
  GROUP BY 1, 2
),
daily AS (
  SELECT CAST(l_shipdate AS DATE) AS day,
         SUM(CAST(floor(l_discount * 100.0 + 0.5) AS BIGINT)) AS disc_sum,
         COUNT(l_discount) AS disc_n,
         SUM(CAST(floor(l_extendedprice / l_quantity * 1000000.0 + 0.5) AS BIGINT)) AS unit_sum,
         COUNT(l_extendedprice / l_quantity) AS unit_n,
         COUNT(*) AS lines,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned
  FROM lineitem WHERE l_shipdate IS NOT NULL
  GROUP BY 1
),
months AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS month, SUM(returned) AS returned, SUM(lines) AS lines
  FROM daily GROUP BY 1
),
obs AS (
  SELECT 'cash_rate' AS series_id, day AS obs_date, CAST(disc_sum AS DOUBLE) / disc_n AS value FROM daily
  UNION ALL
  SELECT 'cpi', day, CAST(unit_sum AS DOUBLE) / unit_n / 1000000.0 FROM daily
  UNION ALL
  SELECT 'unemployment_rate', month, CAST(returned AS DOUBLE) / lines * 100 FROM months
),
quarterly AS (
  SELECT series_id, {period_expr('obs_date')} AS period,
         CASE WHEN series_id = 'cpi' THEN avg(value) ELSE arg_max(value, obs_date) END AS value
  FROM obs WHERE value IS NOT NULL AND NOT isnan(value)
  GROUP BY 1, 2
),
drivers_all AS (
  SELECT period,
         max(value) FILTER (WHERE series_id = 'cash_rate') AS cash_rate,
         max(value) FILTER (WHERE series_id = 'cpi') AS cpi,
         max(value) FILTER (WHERE series_id = 'unemployment_rate') AS unemployment_rate
  FROM quarterly GROUP BY period
),
drivers AS (
  SELECT * FROM drivers_all
  WHERE cash_rate IS NOT NULL AND cpi IS NOT NULL AND unemployment_rate IS NOT NULL
),
panel AS (
  SELECT p.entity, p.period, p.price, d.cash_rate, d.cpi, d.unemployment_rate
  FROM prices p JOIN drivers d ON p.period = d.period
)"""


def feature_ctes(vocab: Sequence[str] = NATION_VOCAB) -> str:
    """CTEs f1..f4 (all derived columns), feat_all (+dummies) and feat (complete rows)."""
    dummies = "".join(
        f",\n         CAST(entity = '{v}' AS INTEGER) AS {dummy_name(v)}" for v in vocab
    )
    required = " AND ".join(f"{c} IS NOT NULL" for c in ["target"] + NUMERIC_FEATURES + [dummy_name(v) for v in vocab])
    return f"""
f1 AS (
  SELECT *,
         lag(price, 1) OVER w AS rppi_lag_1,
         lag(price, 2) OVER w AS rppi_lag_2,
         lag(price, 4) OVER w AS rppi_lag_4,
         (price / lag(price, 1) OVER w - 1) * 100 AS rppi_qoq_pct,
         (price / lag(price, 4) OVER w - 1) * 100 AS rppi_yoy_pct,
         cash_rate - lag(cash_rate, 1) OVER w AS cash_rate_delta,
         lag(cash_rate, 1) OVER w AS cash_rate_lag1,
         (cpi / lag(cpi, 4) OVER w - 1) * 100 AS cpi_yoy_pct,
         lag(cpi, 1) OVER w AS cpi_lag1,
         unemployment_rate - lag(unemployment_rate, 1) OVER w AS unemp_delta,
         lag(unemployment_rate, 1) OVER w AS unemp_lag1,
         row_number() OVER w AS rn
  FROM panel
  WINDOW w AS (PARTITION BY entity ORDER BY period)
),
f2 AS (
  SELECT *,
         CASE WHEN count(rppi_qoq_pct) OVER w4 >= 2 THEN avg(rppi_qoq_pct) OVER w4 END AS rolling_mean_4q,
         CASE WHEN count(rppi_qoq_pct) OVER w4 >= 2 THEN stddev_samp(rppi_qoq_pct) OVER w4 END AS rolling_std_4q,
         lag(rppi_qoq_pct, 1) OVER w AS rppi_qoq_pct_lag1,
         lag(rppi_yoy_pct, 1) OVER w AS rppi_yoy_pct_lag1,
         rppi_qoq_pct - lag(rppi_qoq_pct, 1) OVER w AS price_accel,
         lag(cash_rate_delta, 1) OVER w AS cash_rate_delta_lag1,
         lag(cpi_yoy_pct, 1) OVER w AS cpi_yoy_pct_lag1,
         lag(unemp_delta, 1) OVER w AS unemp_delta_lag1,
         lead(rppi_qoq_pct, 1) OVER w AS target,
         CASE WHEN rn = 1 OR sign(rppi_qoq_pct) IS DISTINCT FROM lag(sign(rppi_qoq_pct), 1) OVER w
              THEN rn END AS run_mark
  FROM f1
  WINDOW w AS (PARTITION BY entity ORDER BY period),
         w4 AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
),
f3 AS (
  SELECT *,
         CAST(sign(rppi_qoq_pct) AS DOUBLE)
           * (rn - max(run_mark) OVER (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1)
           AS momentum_streak
  FROM f2
),
f4 AS (
  SELECT *,
         lag(momentum_streak, 1) OVER w AS momentum_streak_lag1,
         lag(price_accel, 1) OVER w AS price_acceleration_lag1,
         CASE WHEN cash_rate_lag1 IS NULL THEN NULL
              ELSE CAST((cash_rate_lag1 >= 1.0) AS DOUBLE) + CAST((cash_rate_lag1 >= 3.0) AS DOUBLE)
                   + CAST((cash_rate_lag1 >= 6.0) AS DOUBLE) END AS rate_regime,
         CAST(period % 4 + 1 AS INTEGER) AS quarter
  FROM f3
  WINDOW w AS (PARTITION BY entity ORDER BY period)
),
feat_all AS (
  SELECT *,
         sin(2 * pi() * quarter / 4) AS quarter_sin,
         cos(2 * pi() * quarter / 4) AS quarter_cos{dummies}
  FROM f4
),
feat AS (
  SELECT * FROM feat_all WHERE {required}
)"""


def with_features(body: str, vocab: Sequence[str] = NATION_VOCAB, level: str = "nation") -> str:
    return f"WITH {panel_ctes(level)},{feature_ctes(vocab)}\n{body}"


def with_panel(body: str, level: str = "nation") -> str:
    return f"WITH {panel_ctes(level)}\n{body}"


# Testdata split boundaries as period integers (1998Q4, 1999Q4).
TRAIN_END_P = 1998 * 4 + 3
VAL_END_P = 1999 * 4 + 3


def split_case(col: str = "period") -> str:
    return f"CASE WHEN {col} <= {TRAIN_END_P} THEN 'train' WHEN {col} <= {VAL_END_P} THEN 'val' ELSE 'test' END"


def frame_ctes(z: float) -> str:
    """CTEs sp (features + split), long1 (baselines with bounds), pf (+ ensemble)."""
    return f"""
sp AS (SELECT *, {split_case()} AS split FROM feat),
long0 AS (
  SELECT 'naive' AS model, split, entity, period, target AS y, rppi_qoq_pct_lag1 AS pred FROM sp
  UNION ALL
  SELECT 'rolling_mean', split, entity, period, target, rolling_mean_4q FROM sp
),
vstats AS (
  SELECT model, stddev_pop(y - pred) AS sd, avg(abs(y - pred)) AS mae
  FROM long0 WHERE split = 'val' GROUP BY model
),
vw AS (
  SELECT model, CASE WHEN sd > 0 THEN {z!r} * sd ELSE 0.0 END AS half,
         (1.0 / mae) / sum(1.0 / mae) OVER () AS w
  FROM vstats
),
long1 AS (
  SELECT l.model, l.split, l.entity, l.period, l.y, l.pred,
         l.pred - v.half AS lo, l.pred + v.half AS hi, v.w
  FROM long0 l JOIN vw v ON l.model = v.model
),
ens AS (
  SELECT 'ensemble' AS model, split, entity, period, any_value(y) AS y,
         sum(w * pred) AS pred, sum(w * lo) AS lo, sum(w * hi) AS hi
  FROM long1 GROUP BY split, entity, period
),
pf AS (
  SELECT model, split, entity, period, y, pred, lo, hi FROM long1
  UNION ALL
  SELECT model, split, entity, period, y, pred, lo, hi FROM ens
)"""


def with_frame(body: str, z: float, vocab: Sequence[str] = NATION_VOCAB) -> str:
    return f"WITH {panel_ctes()},{feature_ctes(vocab)},{frame_ctes(z)}\n{body}"


def metrics_sql(y: str = "y", pred: str = "pred", where: str | None = None, prefix: str = "",
                names: Sequence[str] = ("mae", "rmse", "r2", "mape", "directional_accuracy", "n_samples")) -> str:
    """Metric aggregates; ``where`` adds a FILTER clause to every aggregate."""
    f = f" FILTER (WHERE {where})" if where else ""
    r = f"({y} - {pred})"
    exprs = {
        "mae": f"avg(abs({r})){f}",
        "rmse": f"sqrt(avg({r} * {r}){f})",
        "r2": f"CASE WHEN var_pop({y}){f} * count({y}){f} > 0 THEN 1.0 - sum({r} * {r}){f} / (var_pop({y}){f} * count({y}){f}) ELSE 0.0 END",
        "mape": f"avg(CASE WHEN {y} <> 0 THEN abs({r} / {y}) END){f} * 100",
        "directional_accuracy": f"avg(CAST(sign({pred}) = sign({y}) AS DOUBLE)){f}",
        "n_samples": f"count(*){f}",
    }
    out = []
    for n in names:
        e = exprs[n]
        out.append(f"{e} AS {prefix}{n}" if n == "n_samples" else f"round(({e}) * 1000000.0) / 1000000.0 AS {prefix}{n}")
    return ",\n       ".join(out)


def pearson_sql(a: str, b: str) -> str:
    """Mirror of functions.scalars.pearson (pairwise complete, NULL when constant)."""
    xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return (f"CASE WHEN stddev_samp({xa}) * stddev_samp({xb}) <> 0 "
            f"THEN covar_samp({xa}, {xb}) / (stddev_samp({xa}) * stddev_samp({xb})) END")
