"""Batch ETL: typed master data + transactions -> star-schema rows.

Plan per load (all lazy DataFrames, one Spark job per written table):

* dimensions: first row per key (customers, products) or last name per key
  (stores, suppliers), minus keys already stored (insert-if-absent);
* facts: transactions matched to known customers (semi join), enriched with
  the product lookup (price, store, supplier) and the calendar key, revenue
  rounded once to cents, then one row per (order_id, product_id): the
  earliest source position, minus keys already stored;
* rejects: every dropped transaction with the reason it was dropped.

Duplicate selection runs after all filters, so a rejected early duplicate
does not hide a valid later one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schema
from sparkmart.functions.calendar import year_of_date_id
from sparkmart.operators import dims
from sparkmart.operators.dedupe import insert_ignore
from sparkmart.operators.joins import enrich_date, enrich_product, with_revenue
from sparkmart.session import checkpoint_root
from sparkmart.sources.calendar import dim_date as make_calendar
from sparkmart.sources.csv import POS

FACT_COLS = [f.name for f in schema.FACT_SALES.fields]


@dataclass
class Star:
    """The six warehouse tables as DataFrames.

    ``fact_sales`` may carry the storage partition column ``sale_year``
    (``date_id`` div 10000) in addition to its eight schema columns.  A stored
    star knows in how many buckets its keyed tables lie.
    """
    dim_customer: DataFrame
    dim_store: DataFrame
    dim_supplier: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    buckets: int = 0                                  # of the stored keyed tables

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schema.STAR_TABLES}

    def facts(self, year: int | None = None) -> DataFrame:
        """Fact rows, optionally of one calendar year (a partition filter when
        the table is stored partitioned by ``sale_year``)."""
        f = self.fact_sales
        if year is None:
            return f
        if schema.FACT_PARTITION in f.columns:
            return f.where(F.col(schema.FACT_PARTITION) == year)
        lo, hi = year * 10000 + 101, year * 10000 + 1231
        return f.where(F.col("date_id").between(lo, hi))


@dataclass
class Inputs:
    """Typed inputs (the cleaners' good rows, each with ``src_pos``)."""
    customers: DataFrame
    products: DataFrame
    transactions: DataFrame
    calendar: tuple[str, str]


def build_facts(inputs: Inputs, dim_date: DataFrame, work: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidate fact rows (before duplicate removal) and rejected transactions.

    With ``work``, a folder that isn't there yet, the joined transactions are
    stored in it, and both results read them instead of joining twice.  Without
    it the facts have a plan of their own, which a load without rejects runs alone:
    a semi join, which Catalyst moves to the table that the customer key comes from,
    so transactions aren't dealt by customer.
    """
    tx = inputs.transactions
    lookup = dims.product_lookup(inputs.products)
    cust = inputs.customers.select("customer_id")
    if not work:
        known = with_revenue(enrich_date(enrich_product(tx.join(cust, "customer_id", "left_semi"), lookup), dim_date))
        known = known.where(F.col("price").isNotNull() & F.col("date_id").isNotNull() & F.col("revenue").isNotNull())
    # One pass tags every transaction; the left joins keep the unmatched rows
    # so good rows and rejects come from the same plan.
    tagged = tx.join(cust.distinct().withColumn("__known", F.lit(True)), "customer_id", "left")
    tagged = with_revenue(enrich_date(enrich_product(tagged, lookup, "left"), dim_date, how="left"))
    reason = (F.when(F.col("__known").isNull(), F.lit("unknown_customer"))
              .when(F.col("price").isNull(), F.lit("unknown_product"))
              .when(F.col("date_id").isNull(), F.lit("date_outside_calendar"))
              .when(F.col("revenue").isNull(), F.lit("revenue_overflow")))
    rejected = ["order_id", "customer_id", "product_id", "quantity", "sale_date", POS, "reason"]
    tagged = tagged.withColumn("reason", reason).select(*dict.fromkeys([*FACT_COLS, *rejected]))
    if work:
        tagged.write.parquet(work)
        tagged = tagged.sparkSession.read.schema(tagged.schema).parquet(work)
    good = (tagged.where(F.col("reason").isNull()) if work else known).select(*FACT_COLS, POS)
    rejects = tagged.where(F.col("reason").isNotNull()).select(*rejected)
    return good, rejects


def new_rows(spark: SparkSession, inputs: Inputs, existing: Star | None = None,
             work: str | None = None) -> tuple[Star, DataFrame]:
    """Rows each table gains from ``inputs`` (insert-if-absent on every key),
    and the rejected transactions; ``work`` as in ``build_facts``.

    With ``existing`` = None this is a first load.  ``dim_date`` is generated
    for ``inputs.calendar`` and only gains days not yet stored.
    """
    ex = existing
    cal = make_calendar(spark, *inputs.calendar)
    facts, rejects = build_facts(inputs, cal, work)

    def ignore(df, name, order=POS):
        keys = schema.PRIMARY_KEYS[name]
        cols = [f.name for f in schema.STAR_TABLES[name].fields]
        keyed = ex.buckets if ex and name in ("dim_customer", "dim_product", "fact_sales") else 0
        return insert_ignore(df, getattr(ex, name) if ex else None, keys, order, cols, keyed)

    # extract_* already yield one row per key.
    stores = dims.extract_stores(inputs.products)
    suppliers = dims.extract_suppliers(inputs.products)
    cal_new = cal if ex is None else cal.join(ex.dim_date.select("date_id"), "date_id", "left_anti")
    out = Star(
        dim_customer=ignore(inputs.customers, "dim_customer"),
        dim_store=ignore(stores, "dim_store", order=None),
        dim_supplier=ignore(suppliers, "dim_supplier", order=None),
        dim_product=ignore(inputs.products.withColumn("price", F.col("price").try_cast("decimal(10,2)")),
                           "dim_product"),
        dim_date=cal_new,
        fact_sales=ignore(facts, "fact_sales"),
    )
    return out, rejects


def star_rows(spark: SparkSession, inputs: Inputs) -> Star:
    """The complete star of a first load, as lazy DataFrames."""
    return new_rows(spark, inputs)[0]


def with_partition_column(fact: DataFrame) -> DataFrame:
    return fact.withColumn(schema.FACT_PARTITION, year_of_date_id("date_id"))


def load_warehouse(spark: SparkSession, inputs: Inputs, root: str,
                   quarantine: dict[str, DataFrame] | None = None) -> dict[str, int]:
    """Load ``inputs`` into the warehouse at ``root`` (first load or
    incremental), with insert-if-absent on every key.

    Rejected transactions (reason per row) and any cleaning rejects passed in
    ``quarantine`` are added to ``root/rejects/<source>`` unless they are
    there.  The joined transactions are stored in the shared checkpoint folder
    for the time of the load, so the joins run once.  Returns the rows added
    per table.
    """
    from sparkmart.sources import warehouse as wh  # storage helpers

    work = f"{checkpoint_root(spark)}/load-{uuid.uuid4().hex}"
    try:
        fresh, rejects = new_rows(spark, inputs, existing=wh.read_star(spark, root), work=work)
        added = wh.write_star(fresh, root, mode="append")
        for source, df in {"transactions_load": rejects, **(quarantine or {})}.items():
            path = f"{root.rstrip('/')}/rejects/{source}/epoch=-1"     # streams write other epochs beside it
            if wh.path_exists(spark, path):               # a reject that is there stays one row
                df = df.subtract(spark.read.schema(df.schema).parquet(path))
            df.write.mode("append").parquet(path)
        return added
    finally:
        wh.remove(spark, work)
