"""Grouping sets with the sets' number, so a subtotal and a missing name differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouping_sets(df: DataFrame, columns: Sequence[str], sets: Sequence[Sequence[str]], *measures: Column,
                  grouping_id: str | None = None) -> DataFrame:
    """``measures`` for each of the grouping ``sets`` of ``columns``, in one pass.

    A column outside a row's set is NULL, and so is a missing value inside it.
    ``grouping_id`` names a column that tells them apart: a number whose bits,
    first column highest, are 1 for the columns that are not in the row's set."""
    number = [F.grouping_id().cast("long").alias(grouping_id)] if grouping_id else []
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(*number, *measures)


def rollup(df: DataFrame, columns: Sequence[str], *measures: Column, grouping_id: str | None = None) -> DataFrame:
    """Subtotals of every leading part of ``columns``, down to the grand total."""
    return grouping_sets(df, columns, [columns[:i] for i in range(len(columns), -1, -1)], *measures, grouping_id=grouping_id)
