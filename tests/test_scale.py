"""Steps that must not grow with what a join or a sort has gathered in a task."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sparkmart import schema
from sparkmart.functions.parsing import parse_date
from sparkmart.operators.quality import duplicate_master_keys
from sparkmart.plans import inputs
from sparkmart.plans.etl import build_facts
from sparkmart.sources import testdata
from sparkmart.sources import warehouse as wh
from sparkmart.sources.calendar import dim_date
from tests import fixtures as fx


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_keys_are_not_counted_inside_a_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.createDataFrame([(1,), (2,)], "id long")
        lines = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, None), (2, None), (2, None)], "id long, k string")
        found = duplicate_master_keys({"lines": (lines.join(orders, "id"), ["id", "k"])})
        assert "REPARTITION_BY_NUM" in plan_of(found)
        assert [tuple(r) for r in found.collect()] == [("lines", 2, 5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orders_are_written_in_source_order_without_a_range_sort(spark):
    rows = [(o, 1, p, q, fx.d("2016-04-02"), r) for o in range(30) for r, (p, q) in enumerate([("P2", 1), ("P1", 2), ("P2", 3)])]
    tx = inputs.by_order(fx.transactions(spark, rows[::-1]).repartition(5))
    assert "rangepartitioning" not in plan_of(tx)
    found = tx.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    for o in range(30):
        mine = sorted((r for r in found if r.order_id == o), key=lambda r: r["at"])
        assert len({r.part for r in mine}) == 1
        assert [(r.product_id, r.quantity) for r in mine] == [("P1", 2), ("P2", 1), ("P2", 3)]


def test_dates_are_cast_before_the_formatter_is_asked(spark):
    texts = ["2016-04-02", "0000-01-01", "2016-02-30", "+12016-01-01", "1500-02-29", "2016-4-2", "2016", "20160402", "1582-10-10", ""]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    raw = F.trim("v")
    other = F.coalesce(F.try_to_date(raw, "yyyy-MM-dd"), parse_date("v"))
    assert df.where(~parse_date("v").eqNullSafe(other)).count() == 0
    text = plan_of(df.select(parse_date("v")))
    assert text.index("cast(trim") < text.index("gettimestamp")


def test_transactions_are_not_dealt_by_customer(spark, scratch):
    """Facts alone: orders are matched to customers before line items join them."""
    tables = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                           "l_shipdate timestamp_ntz", [(o, 1, 1, n, 2.0, 9.0, None) for o in (1, 2, 3) for n in (1, 2)]),
              "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
                         [(1, 1, dt.datetime(2016, 4, 2)), (2, 9, dt.datetime(2016, 4, 2)), (3, None, dt.datetime(2016, 4, 2))])}
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{scratch}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P00000001", 2.0, 0)], [])
        inp.transactions = testdata.transactions(spark, scratch)
        facts, _ = build_facts(inp, dim_date(spark, "2016-01-01", "2016-12-31"))
        plan = plan_of(facts)
        assert plan.index("order_id") < plan.index("Inner") < plan.index("LeftSemi") < plan.index("orders.parquet")
        assert plan.count("hashpartitioning(customer_id") == 2 and plan.index("lineitem.parquet") < plan.index("LeftSemi")
        assert {(r.order_id, r.customer_id, r.product_id) for r in facts.collect()} == {(1, 1, "P00000001")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_alone_are_those_beside_the_rejects(spark, scratch):
    day = fx.d("2016-04-02")
    tx = [(1, 1, "P1", 1, day, 0), (2, 9, "P1", 1, day, 1), (3, None, "P1", 1, day, 2), (4, 1, "PX", 1, day, 3), (5, 1, None, 1, day, 4),
          (6, 1, "P2", 1, day, 5), (7, 1, "P1", 1, fx.d("2031-04-02"), 6), (8, 1, "P1", 1, None, 7), (9, 1, "P3", 2_000_000_000, day, 8),
          (10, 1, "P1", None, day, 9), (11, 1, "P1", 3, day, 10), (11, 1, "P1", 3, day, 11)]
    inp = fx.inputs(spark, [fx.cust_row(1), fx.cust_row(1)],
                    [fx.prod_row("P1", 2.0, 0), fx.prod_row("P2", None, 1), fx.prod_row("P3", 1e9, 2)], tx)
    cal = dim_date(spark, "2016-01-01", "2016-12-31")
    alone, rejects = build_facts(inp, cal)
    beside, _ = build_facts(inp, cal, f"{scratch}/work")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(alone) == rows(beside) and alone.count() == 3 and rejects.count() == len(tx) - 3


def test_stored_tables_are_zstd(spark, scratch):
    wh.write_table(spark, f"{scratch}/wh", "dim_store", spark.createDataFrame([(1, "S")], schema.DIM_STORE))
    assert [f for f in os.listdir(f"{scratch}/wh/dim_store") if f.endswith(".zstd.parquet")]
