"""Fact-building joins: customer match, product and calendar enrichment.

Join strategies are left to Catalyst/AQE (size-checked broadcast below
``autoBroadcastJoinThreshold``, sort-merge otherwise, runtime skew splits).
Only the calendar is hinted for broadcast: its row count is bounded by the
day range it was generated for (``sources.calendar.MAX_DAYS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.measures import revenue


def hybrid_join_batch(transactions: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transactions whose customer exists in the master (inner equi-join on
    the customer key, each transaction emitted once) and the unmatched rest."""
    keys = customers.select("customer_id")
    matched = transactions.join(keys, "customer_id", "left_semi")
    unmatched = transactions.join(keys, "customer_id", "left_anti")
    return matched, unmatched


def enrich_product(df: DataFrame, lookup: DataFrame, how: str = "inner") -> DataFrame:
    """Attach price, store and supplier; transactions of unknown products drop
    out, or with ``how="left"`` stay without them."""
    return df.join(lookup, "product_id", how)


def enrich_product_as_of(df: DataFrame, versions: DataFrame, at: str = "arrival_ts") -> DataFrame:
    """Attach the price, store and supplier that held when the transaction
    arrived: the last of ``versions (product_id, since, src_pos, price, store_id,
    supplier_id)`` with ``since`` not after ``at``.  Transactions of products
    unknown at that time stay with a null ``price``.

    Versions come as one sorted array per product, so a transaction meets one
    row whatever the number of versions."""
    fields = ["since", "src_pos", "price", "store_id", "supplier_id"]
    lists = versions.groupBy("product_id").agg(F.sort_array(F.collect_set(F.struct(*fields))).alias("__versions"))
    held = F.filter("__versions", lambda v: v.since <= F.col(at))
    out = df.join(lists, "product_id", "left").withColumn("__held", F.try_element_at(held, F.lit(-1)))
    return out.select(*df.columns, *[F.col(f"__held.{c}").alias(c) for c in fields[2:]])


def enrich_date(df: DataFrame, dim_date: DataFrame, date_col: str = "sale_date", how: str = "inner") -> DataFrame:
    """Attach ``date_id``; dates outside the calendar drop out, or with
    ``how="left"`` stay without one."""
    cal = F.broadcast(dim_date.select(F.col("full_date").alias("__d"), "date_id"))
    return df.join(cal, F.col(date_col) == F.col("__d"), how).drop("__d")


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", revenue("price", "quantity"))
