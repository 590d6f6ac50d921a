"""Calendar expressions: smart date key, period attributes, day type, season."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekend day names, season by month, half-year split.
WEEKEND_DAYS = ["Saturday", "Sunday"]
SEASONS = [
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
    ("Fall", [9, 10, 11]),
    ("Winter", [12, 1, 2]),
]
FIRST_HALF_LAST_MONTH = 6


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_id(col) -> Column:
    """date -> ``yyyymmdd`` int (arithmetic, no string formatting)."""
    d = _c(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_of_date_id(col) -> Column:
    return (_c(col) / 10000).cast("int")


def weekday_name(col) -> Column:
    return F.date_format(_c(col), "EEEE")


def day_type(weekday) -> Column:
    """'Weekend' for Saturday/Sunday, else 'Weekday' (a NULL weekday too)."""
    return F.when(_c(weekday).isin(*WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def season(month) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASONS:
        expr = (F.when(m.isin(*months), F.lit(name)) if expr is None
                else expr.when(m.isin(*months), F.lit(name)))
    return expr


def is_first_half(month) -> Column:
    return _c(month) <= FIRST_HALF_LAST_MONTH
