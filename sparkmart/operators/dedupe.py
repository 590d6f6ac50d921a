"""Keyed first/last-wins selection and insert-if-absent (``INSERT IGNORE``).

All three are hash/sort aggregates with a map-side partial step, so a key that
holds a large share of the rows is collapsed inside each map task before the
shuffle instead of landing whole in one reducer (a ``row_number`` window would
sort every row of the key in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BEST = "__best"
_ORDER = "__order"


def _pick(df: DataFrame, keys: Sequence[str], order: str, agg, cols) -> DataFrame:
    payload = [c for c in (cols or df.columns) if c not in keys and c != order]
    packed = F.struct(F.col(order).alias(_ORDER), *[F.col(c) for c in payload])
    out = df.groupBy(*keys).agg(agg(packed).alias(_BEST))
    return out.select(*keys, *[F.col(f"{_BEST}.{c}").alias(c) for c in payload])


def first_by(df: DataFrame, keys: Sequence[str], order: str,
             cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest ``order`` value.

    ``order`` is any orderable column (usually the source-position struct);
    ties on it are broken by the remaining columns, so the result does not
    depend on task scheduling.
    """
    return _pick(df, keys, order, F.min, cols)


def last_by(df: DataFrame, keys: Sequence[str], order: str,
            cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the largest ``order`` value."""
    return _pick(df, keys, order, F.max, cols)


def insert_ignore(incoming: DataFrame, existing: DataFrame | None,
                  keys: Sequence[str], order: str | None,
                  cols: Sequence[str] | None = None, buckets: int = 0) -> DataFrame:
    """Rows to append so that ``existing`` keeps its first row per key.

    Within the batch the earliest source position wins; keys already stored
    are dropped (anti join).  Replaying the same batch yields no rows, which
    makes the load idempotent.  ``order=None`` states that ``incoming`` is
    already one row per key (no selection step).  ``buckets``: ``existing`` is a
    table in that many buckets by these keys; the incoming rows are dealt alike,
    once for the selection and the join, and the stored side isn't shuffled.
    """
    if buckets:
        incoming = incoming.repartition(buckets, *keys)
    if order is None:
        fresh = incoming.select(*(cols or incoming.columns))
    else:
        fresh = first_by(incoming, keys, order, cols)
    if existing is None:
        return fresh
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def dedupe_facts_stream(stream: DataFrame, keys: Sequence[str], event_time: str | None = None,
                        within: str | None = None) -> DataFrame:
    """The first row per key of a stream; repeats inside a micro-batch and in
    later ones are dropped, after a restart too (keyed state in the checkpoint).

    Without ``within`` every key is remembered for good (exact).  With it, a key
    is forgotten that long after its row by ``event_time``, which bounds the
    state; repeats that come later pass, and the loader's insert-if-absent
    against the stored keys stops them.  A null in a key counts as a
    value.  Inside a micro-batch rows of one file go by file
    order; which of two files comes first is not defined.
    """
    if within is None:
        return stream.dropDuplicates(list(keys))
    if event_time is None:
        raise ValueError("within needs an event_time column")
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))


def insert_ignore_batch(incoming: DataFrame, existing: DataFrame, keys: Sequence[str],
                        first_key_range: tuple | None = None) -> DataFrame:
    """``insert_ignore`` for a batch, one row per key, against a large stored
    table.

    The stored keys are semi-joined to the batch's: a range filter on the
    first key (the batch's min..max, if given) lets Parquet statistics skip row groups,
    and the batch is the small side, which Spark broadcasts while it is under
    the session's threshold, so the stored side isn't shuffled then.
    """
    if first_key_range is not None:
        lo, hi = first_key_range
        if lo is None:
            return incoming
        existing = existing.where(F.col(keys[0]).between(lo, hi))
    stored = (existing.select(*keys)
              .join(incoming.select(*keys), list(keys), "left_semi"))
    return incoming.join(stored, list(keys), "left_anti")
