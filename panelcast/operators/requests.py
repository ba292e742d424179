"""Scoring requests: validation rules, feature mapping, raw histories.

Two request shapes (see ``VECTOR_FIELDS`` and ``RAW_SCHEMA``):

* vector requests: one flat row of current/lagged values per request;
* raw requests: two arrays of quarterly observations per request.

Validation turns every rule into a message expression and keeps the failing
ones in ``errors ARRAY<STRING>``; valid and invalid rows are then separated
by a filter, so one bad request never fails the batch. Raw histories are
exploded positionally (``arrays_zip``) into a panel keyed by ``request_id``
and go through the same window features as training, partitioned by
request (each request holds at most 40 rows).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import direction, rate_regime
from panelcast.operators import features as feat

# Request field ranges.
YEAR_MIN, YEAR_MAX = 2000, 2050
RATE_MIN, RATE_MAX = 0.0, 30.0
UNEMP_MIN, UNEMP_MAX = 0.0, 100.0
HISTORY_MIN, HISTORY_MAX = 6, 40
PLAUSIBLE_LO, PLAUSIBLE_HI = 0.5, 2.0

# Fields of a flat request.
VECTOR_FIELDS = [
    "rppi_current", "rppi_lag1", "rppi_lag2", "rppi_lag4", "rppi_qoq_pct_current", "rppi_yoy_pct_current",
    "rolling_mean_4q", "rolling_std_4q", "momentum_streak", "price_acceleration",
    "cash_rate", "cash_rate_prev", "cpi", "cpi_prev_year", "unemployment_rate", "unemployment_rate_prev",
]

RAW_SCHEMA = (
    "request_id STRING, entity STRING, "
    "rppi_history ARRAY<STRUCT<year: INT, quarter: INT, rppi_index: DOUBLE>>, "
    "macro_history ARRAY<STRUCT<year: INT, quarter: INT, cash_rate: DOUBLE, cpi: DOUBLE, unemployment_rate: DOUBLE>>"
)


def _rule(ok: Column, message: str) -> Column:
    """Message when the rule fails (a NULL input fails too)."""
    return F.when(~F.coalesce(ok, F.lit(False)), F.lit(message))


def _errors(rules: Sequence[Column]) -> Column:
    return F.filter(F.array(*rules), lambda m: m.isNotNull())


def vector_rules(vocabulary: Sequence[str]) -> list[Column]:
    c = F.col
    rules = [
        _rule(c("entity").isin(list(vocabulary)), "entity: not a known entity"),
        _rule(c("quarter").between(1, 4), "quarter: must be 1, 2, 3 or 4"),
        _rule(c("year").between(YEAR_MIN, YEAR_MAX), f"year: must be between {YEAR_MIN} and {YEAR_MAX}"),
    ]
    for f in ("rppi_current", "rppi_lag1", "rppi_lag2", "rppi_lag4", "cpi", "cpi_prev_year"):
        rules.append(_rule(c(f) > 0, f"{f}: must be greater than 0"))
    for f in ("rppi_qoq_pct_current", "rppi_yoy_pct_current", "rolling_mean_4q"):
        rules.append(_rule(c(f).isNotNull() & ~F.isnan(c(f)), f"{f}: required"))
    rules.append(_rule(c("rolling_std_4q") >= 0, "rolling_std_4q: must be at least 0"))
    for f in ("cash_rate", "cash_rate_prev"):
        rules.append(_rule(c(f).between(RATE_MIN, RATE_MAX), f"{f}: must be between {RATE_MIN:g} and {RATE_MAX:g}"))
    for f in ("unemployment_rate", "unemployment_rate_prev"):
        rules.append(_rule(c(f).between(UNEMP_MIN, UNEMP_MAX), f"{f}: must be between {UNEMP_MIN:g} and {UNEMP_MAX:g}"))
    ratio = F.try_divide(c("rppi_current"), c("rppi_lag4"))
    rules.append(_rule((ratio > PLAUSIBLE_LO) & (ratio < PLAUSIBLE_HI),
                       f"rppi_current: plausible values are {PLAUSIBLE_LO} to {PLAUSIBLE_HI} times rppi_lag4"))
    return rules


def with_defaults(requests: DataFrame) -> DataFrame:
    """Optional fields default to 0 (streak, acceleration)."""
    return requests.withColumns({
        "momentum_streak": F.coalesce(F.col("momentum_streak"), F.lit(0.0)),
        "price_acceleration": F.coalesce(F.col("price_acceleration"), F.lit(0.0)),
    })


def validate_vector(requests: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    return with_defaults(requests).withColumn("errors", _errors(vector_rules(vocabulary)))


def map_vector_request(requests: DataFrame, vocabulary: Sequence[str], prefix: str = "entity_") -> DataFrame:
    """Model inputs from a vector request, exactly as the serving path maps
    them: *current* qoq/yoy/cpi and current-minus-previous deltas stand in
    for the lagged panel features (a known training/serving skew)."""
    c = F.col
    cols = {
        "rppi_lag_1": c("rppi_lag1"),
        "rppi_lag_2": c("rppi_lag2"),
        "rppi_lag_4": c("rppi_lag4"),
        "rppi_qoq_pct_lag1": c("rppi_qoq_pct_current"),
        "rppi_yoy_pct_lag1": c("rppi_yoy_pct_current"),
        "rolling_mean_4q": c("rolling_mean_4q"),
        "rolling_std_4q": c("rolling_std_4q"),
        "momentum_streak_lag1": c("momentum_streak"),
        "price_acceleration_lag1": c("price_acceleration"),
        "cash_rate_lag1": c("cash_rate_prev"),
        "cash_rate_delta_lag1": c("cash_rate") - c("cash_rate_prev"),
        "rate_regime": rate_regime(c("cash_rate_prev")),
        "cpi_lag1": c("cpi"),
        "cpi_yoy_pct_lag1": (F.try_divide(c("cpi"), c("cpi_prev_year")) - 1) * 100,
        "unemp_lag1": c("unemployment_rate_prev"),
        "unemp_delta_lag1": c("unemployment_rate") - c("unemployment_rate_prev"),
        "quarter": c("quarter").cast("int"),
        "quarter_sin": F.sin(F.lit(2 * math.pi) * c("quarter") / 4),
        "quarter_cos": F.cos(F.lit(2 * math.pi) * c("quarter") / 4),
    }
    cols.update({feat.dummy_name(v, prefix): (c("entity") == F.lit(v)).cast("int") for v in vocabulary})
    return requests.withColumns(cols)


def next_year_quarter(year: Column, quarter: Column) -> tuple[Column, Column]:
    p = year * 4 + quarter  # period of the next quarter (year*4 + q - 1 + 1)
    return F.floor(p / 4).cast("int"), (F.pmod(p, F.lit(4)) + 1).cast("int")


def response_columns(pred: Column, lo: Column, hi: Column, confidence: float = 0.90) -> list[Column]:
    """Rounded point and bounds (4 dp), direction label, confidence."""
    return [
        F.round(pred, 4).alias("predicted_qoq_pct_change"),
        direction(pred).alias("direction"),
        F.round(lo, 4).alias("lower"),
        F.round(hi, 4).alias("upper"),
        F.lit(confidence).alias("confidence"),
    ]


# ---------------------------------------------------------------------------
# Raw histories
# ---------------------------------------------------------------------------

def raw_rules(vocabulary: Sequence[str]) -> list[Column]:
    r, m = F.col("rppi_history"), F.col("macro_history")
    n_r, n_m = F.size(r), F.size(m)
    rules = [
        _rule(F.col("entity").isin(list(vocabulary)), "entity: not a known entity"),
        _rule(n_r.between(HISTORY_MIN, HISTORY_MAX), f"rppi_history: must have {HISTORY_MIN} to {HISTORY_MAX} items"),
        _rule(n_m.between(HISTORY_MIN, HISTORY_MAX), f"macro_history: must have {HISTORY_MIN} to {HISTORY_MAX} items"),
        _rule(n_r == n_m, "rppi_history and macro_history must have the same length"),
        _rule(F.forall(F.arrays_zip(r.alias("r"), m.alias("m")),
                       lambda z: (z["r"]["year"] == z["m"]["year"]) & (z["r"]["quarter"] == z["m"]["quarter"])),
              "period mismatch between rppi_history and macro_history"),
        _rule(F.forall(r, lambda o: o["year"].between(YEAR_MIN, YEAR_MAX) & o["quarter"].between(1, 4)),
              f"rppi_history: year must be between {YEAR_MIN} and {YEAR_MAX}, quarter 1-4"),
        _rule(F.forall(m, lambda o: o["year"].between(YEAR_MIN, YEAR_MAX) & o["quarter"].between(1, 4)),
              f"macro_history: year must be between {YEAR_MIN} and {YEAR_MAX}, quarter 1-4"),
        _rule(F.forall(r, lambda o: o["rppi_index"] > 0), "rppi_history: rppi_index must be greater than 0"),
        _rule(F.forall(m, lambda o: o["cash_rate"].between(RATE_MIN, RATE_MAX)),
              f"macro_history: cash_rate must be between {RATE_MIN:g} and {RATE_MAX:g}"),
        _rule(F.forall(m, lambda o: o["cpi"] > 0), "macro_history: cpi must be greater than 0"),
        _rule(F.forall(m, lambda o: o["unemployment_rate"].between(UNEMP_MIN, UNEMP_MAX)),
              f"macro_history: unemployment_rate must be between {UNEMP_MIN:g} and {UNEMP_MAX:g}"),
    ]
    return rules


def validate_raw(requests: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    return requests.withColumn("errors", _errors(raw_rules(vocabulary)))


def raw_to_panel(requests: DataFrame) -> DataFrame:
    """(request_id, entity, period, price, drivers): i-th rppi item with the
    i-th macro item (positional pairing, a narrow ``inline``)."""
    zipped = F.arrays_zip(F.col("rppi_history").alias("r"), F.col("macro_history").alias("m"))
    rows = requests.select("request_id", "entity", F.inline(zipped))
    return rows.select(
        "request_id", "entity",
        (F.col("r.year") * 4 + F.col("r.quarter") - 1).cast("int").alias("period"),
        F.col("r.rppi_index").alias("price"),
        F.col("m.cash_rate").alias("cash_rate"), F.col("m.cpi").alias("cpi"),
        F.col("m.unemployment_rate").alias("unemployment_rate"),
    )


def raw_latest_features(valid: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Last complete feature row of every request (windows per request)."""
    panel = raw_to_panel(valid)
    inf = feat.build_inference(panel, vocabulary, entity="request_id", dummy_col="entity")
    return feat.latest_rows(inf, entity="request_id")


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.size("errors") == 0
    return validated.where(ok).drop("errors"), validated.where(~ok)
