"""Calendar dimension generator (``dim_date``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.calendar import date_id, weekday_name

DEFAULT_START = "2010-01-01"
DEFAULT_END = "2030-12-31"
# The calendar is broadcast into joins; its size is bounded by the day range.
MAX_DAYS = 366 * 400


def calendar_days(start: str, end: str) -> int:
    n = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    if n <= 0 or n > MAX_DAYS:
        raise ValueError(f"calendar range {start}..{end} has {n} days (limit {MAX_DAYS})")
    return n


def dim_date(spark: SparkSession, start: str = DEFAULT_START,
             end: str = DEFAULT_END) -> DataFrame:
    """One row per day in ``[start, end]``: date_id, full_date, day, month,
    quarter, year, weekday (English name)."""
    n = calendar_days(start, end)
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return (spark.range(0, n, numPartitions=max(1, min(8, n // 4096)))
            .select(d.alias("full_date"))
            .select(
                date_id("full_date").alias("date_id"),
                "full_date",
                F.dayofmonth("full_date").alias("day"),
                F.month("full_date").alias("month"),
                F.quarter("full_date").alias("quarter"),
                F.year("full_date").alias("year"),
                weekday_name("full_date").alias("weekday"),
            ))
