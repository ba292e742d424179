"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from panelcast.functions.periods import (
    excel_serial_to_date,
    next_period,
    parse_period,
    period_label,
    period_of,
    period_quarter,
    period_to_int,
    period_year,
)
from panelcast.functions.scalars import (
    banded_direction,
    clean_series_name,
    direction,
    nan_to_null,
    pct_change,
    quarter_cos,
    quarter_sin,
    rate_regime,
)

__all__ = [
    "banded_direction",
    "clean_series_name",
    "direction",
    "excel_serial_to_date",
    "nan_to_null",
    "next_period",
    "parse_period",
    "pct_change",
    "period_label",
    "period_of",
    "period_quarter",
    "period_to_int",
    "period_year",
    "quarter_cos",
    "quarter_sin",
    "rate_regime",
]
