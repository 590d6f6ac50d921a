"""Catalog tables of a warehouse: keyed buckets, names, persistent view."""

import re

import pytest

from sparkmart import schema
from sparkmart.operators.dedupe import insert_ignore
from sparkmart.plans.etl import load_warehouse, new_rows
from sparkmart.sources import warehouse as wh
from tests import fixtures as fx


def some(spark, orders, price=2.0):
    return fx.inputs(spark, [fx.cust_row(1), fx.cust_row(2)], [fx.prod_row("P1", price, 0), fx.prod_row("P2", 3.0, 1)],
                     [(i, 1 + i % 2, f"P{1 + i % 2}", 1, fx.d(f"201{5 + i % 2}-04-0{1 + i % 9}"), i) for i in orders])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_keys_are_never_shuffled(spark, scratch):
    root = f"{scratch}/wh"
    load_warehouse(spark, some(spark, range(50)), root)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh, _ = new_rows(spark, some(spark, range(40, 60)), wh.read_star(spark, root))
        for name, (keys, _) in wh.BUCKETED.items():
            plan = plan_of(getattr(fresh, name))
            stored = plan[plan.index("LeftAnti"):].split("\n")
            # Below the anti join the second child, the stored table, has no exchange above its scan.
            scan = next(i for i, line in enumerate(stored) if "FileScan parquet" in line and "Bucketed: true" in line)
            above = [line for line in stored[:scan] if re.match(r"^[ :]*\+- ", line)]
            depth = stored[scan].index("FileScan") if "FileScan" in stored[scan] else 0
            path, width = [], depth
            for line in reversed(stored[:scan]):
                at = len(line) - len(line.lstrip(" :+-"))
                if at < width:
                    path.append(line)
                    width = at
            assert above and not any("Exchange" in line for line in path), plan
            assert {r[0] for r in fresh.fact_sales.select("order_id").collect()} == set(range(50, 60))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_stay_as_laid_out(spark, scratch):
    root = f"{scratch}/wh"
    load_warehouse(spark, some(spark, range(10)), root)
    n = wh.buckets(spark, root)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert wh.buckets(spark, root) == n
        assert load_warehouse(spark, some(spark, range(5, 15)), root)["fact_sales"] == 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.order_id for r in wh.read_star(spark, root).fact_sales.collect()) == list(range(15))


def test_another_application_finds_the_rows(spark, scratch):
    """The catalog may be empty: the folder says what is stored."""
    root = f"{scratch}/wh"
    load_warehouse(spark, some(spark, range(10)), root)
    spark.sql(f"DROP DATABASE {wh.table_name(root, '').rstrip('.')} CASCADE")
    star = wh.read_star(spark, root)
    assert star.fact_sales.count() == 10 and star.buckets == wh.buckets(spark, root)
    assert load_warehouse(spark, some(spark, range(12)), root)["fact_sales"] == 2


def test_a_plain_root_is_read_and_appended_as_it_is(spark, scratch):
    root = f"{scratch}/wh"
    spark.createDataFrame([(1, "S")], schema.DIM_STORE).write.parquet(f"{root}/dim_store")
    assert wh.buckets(spark, root) == 0
    assert load_warehouse(spark, some(spark, range(4)), root)["fact_sales"] == 4
    assert {r.store_name for r in wh.read_star(spark, root).dim_store.collect()} == {"S"}
    assert load_warehouse(spark, some(spark, range(4)), root) == dict.fromkeys(schema.STAR_TABLES, 0)


def test_tables_and_view_by_name_in_another_session(spark, scratch):
    root = f"{scratch}/wh"
    load_warehouse(spark, some(spark, range(10)), root)
    wh.create_star(spark, root, "shop")
    other = spark.newSession()
    view = "SELECT * FROM shop.STORE_QUARTERLY_SALES ORDER BY year"
    assert [(r.store_name, r.year, r.quarter, str(r.total_quarterly_sales)) for r in other.sql(view).collect()] == [
        ("S1", 2015, 2, "10.00"), ("S1", 2016, 2, "15.00")]
    load_warehouse(spark, some(spark, range(12)), root)
    other.catalog.refreshTable("shop.fact_sales")
    assert other.sql("SELECT count(*) AS n FROM shop.fact_sales").first().n == 12
    wh.create_star(spark, root, "shop")                                          # again: the files stay
    assert other.sql("SELECT count(*) AS n FROM shop.dim_customer").first().n == 2
    wh.create_star(spark, root, "shop", replace=True)
    other.catalog.refreshTable("shop.fact_sales")
    assert other.sql("SELECT count(*) AS n FROM shop.fact_sales").first().n == 0
    assert wh.read_star(spark, root).fact_sales.count() == 0


@pytest.mark.parametrize("buckets", [0, 4])
def test_insert_ignore_with_and_without_buckets(spark, buckets):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "x", 0), (3, "z", 2), (3, "y", 1)], "k long, v string, pos int")
    assert [tuple(r) for r in insert_ignore(new, old, ["k"], "pos", ["k", "v"], buckets).collect()] == [(3, "y")]
