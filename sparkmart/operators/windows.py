"""Ranking and period-over-period window operators.

Both run on already-aggregated rows (one per group and period), so the window
shuffle carries the aggregate, not the fact table.  ``top_n_per_group`` is a
``rank() <= k`` filter, which Spark plans as a partial ``WindowGroupLimit``
before the shuffle: each map task forwards at most its own top k (plus ties)
per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.measures import growth_pct


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n_per_group(df: DataFrame, partition: Sequence[str | Column], order_desc: str,
                    k: int = 5, rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` by ``order_desc`` (descending) within the
    partition is at most ``k``; ties at the cut are all kept."""
    w = Window.partitionBy(*_cols(partition)).orderBy(F.col(order_desc).desc())
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= k)


def period_over_period(df: DataFrame, partition: Sequence[str], period: Sequence[str],
                       measure: str, previous_col: str, growth_col: str) -> DataFrame:
    """Previous row's ``measure`` in period order (``lag(measure, 1, 0)``) and
    the growth in percent (NULL when the previous value is 0 or absent).

    "Previous" is the previous existing row of the partition, not the
    previous calendar period.
    """
    w = Window.partitionBy(*_cols(partition)).orderBy(*_cols(period))
    prev = F.lag(measure, 1, 0).over(w)
    return (df.withColumn(previous_col, prev)
              .withColumn(growth_col, growth_pct(measure, previous_col)))
