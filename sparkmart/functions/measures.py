"""Money and ratio expressions.

Money stays decimal so sums, ranks and ties are exact and independent of
summation order; ratios are computed in double from exact decimal inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REVENUE_TYPE = "decimal(12,2)"
PRICE_TYPE = "decimal(10,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def revenue(price, quantity) -> Column:
    """Unrounded price x quantity, rounded once to cents; NULL on overflow."""
    return (_c(price) * _c(quantity)).try_cast(REVENUE_TYPE)


def growth_pct(current, previous) -> Column:
    """(current - previous) / previous * 100; NULL when previous is 0."""
    cur = _c(current).cast("double")
    prev = _c(previous).cast("double")
    return F.when(prev == 0, F.lit(None).cast("double")).otherwise((cur - prev) / prev * 100)


def safe_ratio(numerator, denominator) -> Column:
    """numerator / denominator when denominator > 0, else NULL."""
    den = _c(denominator).cast("double")
    return F.when(den > 0, _c(numerator).cast("double") / den)


def cents(col) -> Column:
    """Exact integer cents of a decimal(?,2) amount, as decimal(38,0)."""
    return (_c(col) * 100).cast("decimal(38,0)")
