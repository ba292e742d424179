"""Calendar-quarter encoding.

A period is the integer ``year * 4 + quarter - 1``: the next quarter is
``period + 1`` and ordering is integer ordering.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Excel's day zero (serial 0) for dates stored as numbers.
EXCEL_EPOCH = "1899-12-30"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_of(date: ColumnOrName) -> Column:
    """Calendar quarter of a date / timestamp as a period integer."""
    d = _col(date)
    return (F.year(d) * 4 + F.quarter(d) - 1).cast("int")


def period_year(period: ColumnOrName) -> Column:
    return F.floor(_col(period) / 4).cast("int")


def period_quarter(period: ColumnOrName) -> Column:
    return (F.pmod(_col(period), F.lit(4)) + 1).cast("int")


def period_label(period: ColumnOrName) -> Column:
    """``YYYYQn`` label."""
    p = _col(period)
    return F.concat(period_year(p).cast("string"), F.lit("Q"), period_quarter(p).cast("string"))


def next_period(period: ColumnOrName, k: int = 1) -> Column:
    return (_col(period) + k).cast("int")


def parse_period(label: ColumnOrName) -> Column:
    """``YYYYQn`` (case-insensitive, optional blanks) to a period; NULL if malformed."""
    s = F.upper(F.trim(_col(label)))
    pattern = r"^(\d{4})\s*Q([1-4])$"
    y = F.regexp_extract(s, pattern, 1).try_cast("int")
    q = F.regexp_extract(s, pattern, 2).try_cast("int")
    return F.when(s.rlike(pattern), (y * 4 + q - 1).cast("int"))


def period_to_int(label: str | int) -> int:
    """Driver-side parse of a split boundary such as ``'2018Q4'``."""
    if isinstance(label, int):
        return label
    m = re.fullmatch(r"\s*(\d{4})\s*[Qq]([1-4])\s*", label)
    if not m:
        raise ValueError(f"not a quarter label: {label!r}")
    return int(m.group(1)) * 4 + int(m.group(2)) - 1


def int_to_label(period: int) -> str:
    return f"{period // 4}Q{period % 4 + 1}"


def excel_serial_to_date(serial: ColumnOrName) -> Column:
    """Day ``serial`` after 1899-12-30; fractional days are truncated."""
    s = _col(serial).cast("double")
    s = F.when(~F.isnan(s), s)
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), s.try_cast("int"))
