"""Named queries: ``(spark, sf_dir) -> DataFrame`` for every report, ETL
output and check, over the test tables in ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schema
from sparkmart.operators import dims, quality
from sparkmart.operators.joins import hybrid_join_batch
from sparkmart.plans import olap
from sparkmart.plans.etl import FACT_COLS, build_facts, new_rows, star_rows
from sparkmart.plans.inputs import csv_inputs, export_testdata_csv, testdata_inputs
from sparkmart.sources import testdata, warehouse
from sparkmart.sources.calendar import dim_date as make_calendar

Query = Callable[[SparkSession, str], DataFrame]


def _report(name: str) -> Query:
    return lambda spark, sf: olap.run_report(name, warehouse.star_for(spark, sf))


def _table(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = getattr(warehouse.star_for(spark, sf), name)
        return df.select(*[f.name for f in schema.STAR_TABLES[name].fields])
    return run


def row_count_audit(spark: SparkSession, sf: str) -> DataFrame:
    return quality.row_count_audit(warehouse.star_for(spark, sf).tables())


def product_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.product_coverage(testdata.transactions(spark, sf), testdata.products(spark, sf))


def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pk_violations(warehouse.star_for(spark, sf).tables())


def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    star = warehouse.star_for(spark, sf)
    return quality.fk_violations(star.fact_sales, star.tables())


def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.length_violations(warehouse.star_for(spark, sf).tables())


def trailing_months(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows of the trailing six months up to the Q6 anchor (P16)."""
    star = warehouse.star_for(spark, sf)
    rows = olap.trailing_months(star, olap.TEST_PARAMS["q06"]["anchor"], 6)
    return rows.select(*FACT_COLS, "full_date")


def master_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_master_keys({
        "customer_master": (testdata.customers(spark, sf), ["customer_id"]),
        "product_master": (testdata.products(spark, sf), ["product_id"]),
        "transactions": (testdata.transactions(spark, sf), ["order_id", "product_id"]),
    })


def product_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return dims.product_lookup(testdata.products(spark, sf))


def hybrid_join(spark: SparkSession, sf: str) -> DataFrame:
    matched, _ = hybrid_join_batch(testdata.transactions(spark, sf), testdata.customers(spark, sf))
    return matched.select("order_id", "customer_id", "product_id", "quantity", "sale_date")


def fact_sales_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Full CSV path: the test inputs written as the reference's three text
    files, read back, cleaned and loaded (facts only, not stored)."""
    folder = warehouse.warehouse_root(spark, sf, tag="csv")
    if not warehouse.exists(spark, folder):
        export_testdata_csv(spark, sf, folder)
        warehouse.complete(spark, folder)
    cleaned = csv_inputs(spark, folder, calendar=testdata.calendar_range(spark, sf))
    return star_rows(spark, cleaned.inputs).fact_sales.select(*FACT_COLS)


def reload_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows a second load of the same inputs would add (all zero)."""
    star = warehouse.star_for(spark, sf)
    fresh, _ = new_rows(spark, testdata_inputs(spark, sf), existing=star)
    parts = [df.agg(F.count(F.lit(1)).alias("new_rows")).select(F.lit(n).alias("table_name"), "new_rows")
             for n, df in fresh.tables().items()]
    return reduce(DataFrame.unionByName, parts)


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What the loader rejects of a feed in which some orders have an unknown
    product, a date outside the calendar or an unknown customer."""
    inputs = testdata_inputs(spark, sf)
    k = F.col("order_id") % 50
    tx = (inputs.transactions
          .withColumn("product_id", F.when(k == 1, F.concat(F.lit("X"), "product_id")).otherwise(F.col("product_id")))
          .withColumn("sale_date", F.when(k == 2, F.add_months("sale_date", 1200)).otherwise(F.col("sale_date")))
          .withColumn("customer_id", F.when(k == 3, -1 - F.col("customer_id")).otherwise(F.col("customer_id"))))
    _, bad = build_facts(replace(inputs, transactions=tx), make_calendar(spark, *inputs.calendar))
    return bad.select("order_id", "customer_id", "product_id", "quantity", "sale_date", "reason")


def view_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The store view, queried by name in a session that didn't make it."""
    warehouse.star_for(spark, sf)
    root = warehouse.warehouse_root(spark, sf)
    database = warehouse.table_name(root, "").rstrip(".") + "_named"
    warehouse.create_star(spark, root, database)
    store = olap.TEST_PARAMS["q20"]["store_name"]
    return spark.newSession().sql(f"SELECT * FROM {database}.STORE_QUARTERLY_SALES WHERE store_name = :store", {"store": store})


def rollup_with_grouping_id(spark: SparkSession, sf: str) -> DataFrame:
    return olap.q17_yearly_rollup(warehouse.star_for(spark, sf), grouping_id="subtotal")


def _streaming(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        from sparkmart.streaming import jobs  # streaming imports stay lazy
        return getattr(jobs, name)(spark, sf)
    return run


QUERIES: dict[str, Query] = {name: _report(name) for name in olap.REPORTS}
QUERIES.update({
    "x1_row_count_audit": row_count_audit,
    "x2_product_coverage": product_coverage,
    "etl_dim_customer": _table("dim_customer"),
    "etl_dim_product": _table("dim_product"),
    "etl_dim_store": _table("dim_store"),
    "etl_dim_supplier": _table("dim_supplier"),
    "etl_dim_date": _table("dim_date"),
    "etl_fact_sales": _table("fact_sales"),
    "etl_fact_sales_from_csv": fact_sales_from_csv,
    "etl_product_lookup": product_lookup,
    "etl_hybrid_join_batch": hybrid_join,
    "etl_reload_new_rows": reload_new_rows,
    "etl_rejects": rejects,
    "etl_trailing_months": trailing_months,
    "catalog_view_by_name": view_by_name,
    "q17_rollup_grouping_id": rollup_with_grouping_id,
    "check_pk_violations": pk_violations,
    "check_fk_violations": fk_violations,
    "check_master_duplicates": master_duplicates,
    "check_length_violations": length_violations,
    "stream_hybrid_join": _streaming("stream_hybrid_join"),
    "stream_store_quarterly": _streaming("stream_store_quarterly"),
    **{name: _streaming(name) for name in [
        "stream_replay_facts", "stream_replay_dim_customer", "stream_replay_dim_product", "stream_expired", "stream_rejects",
        "stream_replay_balance", "stream_dedupe_facts"]},
})
