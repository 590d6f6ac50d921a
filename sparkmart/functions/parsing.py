"""Column expressions that turn raw text into typed values (all JVM-side).

Every parser returns NULL for input it cannot read; the cleaning operators
route such rows to the quarantine output with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fallback date layouts tried after the strict ISO form,
# in this order (US month-first before day-first, as a general parser does).
DATE_FALLBACK_FORMATS = [
    "M/d/yyyy",
    "yyyy/M/d",
    "M-d-yyyy",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "yyyyMMdd",
]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_long_key(col) -> Column:
    """Integer key from text such as ``10``, ``10.0`` or `` 10 ``.

    Values that only parse as a number with a fraction are truncated, as a
    float-typed column would be by ``int()``.  Text that is not a number gives
    NULL.
    """
    c = F.trim(_c(col).cast("string"))
    as_long = c.try_cast("bigint")
    via_double = c.try_cast("double")
    fallback = F.when(F.isnan(via_double) | (F.abs(via_double) > F.lit(9.2e18)), F.lit(None)) \
        .otherwise(via_double.try_cast("bigint"))
    return F.coalesce(as_long, fallback)


def to_int(col) -> Column:
    c = to_long_key(col)
    return F.when(c.between(-2147483648, 2147483647), c.cast("int"))


def parse_price(col) -> Column:
    """``$1,234.50`` -> 1234.5; plain number -> itself; unreadable text -> 0.0.

    A missing cell, ``nan`` and infinities give NULL (quarantined by the
    caller) instead of propagating into revenue.
    """
    raw = F.trim(_c(col).cast("string"))
    dollar = F.regexp_replace(raw, r"[$,]", "").try_cast("double")
    plain = raw.try_cast("double")
    value = F.when(raw.startswith("$"), dollar).otherwise(plain)
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return (F.when(raw.isNull() | (raw == "") | bad, F.lit(None).cast("double"))
            .otherwise(F.coalesce(value, F.lit(0.0))))


def parse_date(col) -> Column:
    """The ISO date cast first (it reads ``yyyy-MM-dd``, and accepts ``2016-4-2``
    and a trailing time), then ``yyyy-MM-dd`` by the formatter and the fallback
    layouts.  The cast and the formatter agree wherever both read a date, and the
    cast is several times cheaper."""
    raw = F.trim(_c(col).cast("string"))
    tries = [raw.try_cast("date"), F.try_to_date(raw, "yyyy-MM-dd")]
    tries += [F.try_to_date(raw, fmt) for fmt in DATE_FALLBACK_FORMATS]
    return F.coalesce(*tries)


def parse_flag(col) -> Column:
    """0/1 text -> boolean; any non-zero number is true; unreadable -> NULL."""
    n = F.trim(_c(col).cast("string")).try_cast("double")
    return F.when(F.isnan(n), F.lit(None).cast("boolean")).otherwise(n != 0)


def text_or_null(col) -> Column:
    """Trimmed text; empty and the literal ``nan`` (how a missing cell reads
    after a float round trip) become NULL."""
    t = F.trim(_c(col).cast("string"))
    return F.when((t == "") | (F.lower(t) == "nan"), F.lit(None).cast("string")).otherwise(t)
