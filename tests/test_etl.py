"""Load rules: first/last wins, revenue rounding, rejects, idempotent reload."""

from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.plans.etl import build_facts, new_rows, star_rows
from sparkmart.sources.calendar import dim_date
from sparkmart.sources.warehouse import read_star, write_star
from tests import fixtures as fx


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_duplicate_product_first_in_dim_last_in_revenue(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)],
                    [fx.prod_row("P1", 10.0, 0), fx.prod_row("P1", 12.0, 1)],
                    [(7, 1, "P1", 2, fx.d("2016-04-02"), 0)])
    star = star_rows(spark, inp)
    assert _rows(star.dim_product, "product_id", "price") == [("P1", Decimal("10.00"))]
    assert _rows(star.fact_sales, "order_id", "revenue") == [(7, Decimal("24.00"))]


def test_store_name_last_row_wins_but_stored_name_stays(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)],
                    [fx.prod_row("P1", 1.0, 0, store=5, store_name="A"),
                     fx.prod_row("P2", 1.0, 1, store=5, store_name="B")], [])
    first = star_rows(spark, inp)
    assert _rows(first.dim_store, "store_id", "store_name") == [(5, "B")]
    later = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P3", 1.0, 0, store=5, store_name="C")], [])
    fresh, _ = new_rows(spark, later, existing=first)
    assert fresh.dim_store.count() == 0


def test_duplicate_order_product_earliest_position_wins(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)],
                    [(7, 1, "P1", 5, fx.d("2016-04-02"), 3), (7, 1, "P1", 9, fx.d("2016-04-02"), 1)])
    assert _rows(star_rows(spark, inp).fact_sales, "order_id", "quantity") == [(7, 9)]


def test_revenue_rounds_once(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 12.345, 0)],
                    [(7, 1, "P1", 3, fx.d("2016-04-02"), 0)])
    star = star_rows(spark, inp)
    assert _rows(star.fact_sales, "revenue") == [(Decimal("37.04"),)]
    assert _rows(star.dim_product, "price") == [(Decimal("12.35"),)]


def test_rejects_carry_reasons(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [
        (1, 1, "P1", 1, fx.d("2016-04-02"), 0),   # good
        (2, 9, "P1", 1, fx.d("2016-04-02"), 1),   # unknown customer
        (3, 1, "PX", 1, fx.d("2016-04-02"), 2),   # unknown product
        (4, 1, "P1", 1, fx.d("1990-01-01"), 3),   # outside the calendar
    ])
    good, rejects = build_facts(inp, dim_date(spark, *inp.calendar))
    assert _rows(good, "order_id") == [(1,)]
    assert _rows(rejects, "order_id", "reason") == [
        (2, "unknown_customer"), (3, "unknown_product"), (4, "date_outside_calendar")]


def test_rejected_early_duplicate_does_not_hide_valid_one(spark):
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [
        (7, 1, "P1", 1, fx.d("1990-01-01"), 0),
        (7, 1, "P1", 4, fx.d("2016-04-02"), 1),
    ])
    assert _rows(star_rows(spark, inp).fact_sales, "quantity") == [(4,)]


def test_reload_is_idempotent(spark, scratch):
    inp = fx.inputs(spark, [fx.cust_row(1), fx.cust_row(2)],
                    [fx.prod_row("P1", 2.0, 0), fx.prod_row("P2", 3.0, 1, store=2, sup=2)],
                    [(1, 1, "P1", 1, fx.d("2016-04-02"), 0), (1, 2, "P2", 2, fx.d("2016-04-03"), 1)])
    counts = write_star(star_rows(spark, inp), f"{scratch}/wh")
    assert counts["fact_sales"] == 2 and counts["dim_store"] == 2
    stored = read_star(spark, f"{scratch}/wh")
    fresh, _ = new_rows(spark, inp, existing=stored)
    assert {n: df.count() for n, df in fresh.tables().items()} == {n: 0 for n in counts}


def test_load_warehouse_twice_with_rejects(spark, scratch):
    from sparkmart.plans.etl import load_warehouse
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [
        (1, 1, "P1", 1, fx.d("2016-04-02"), 0), (2, 9, "P1", 1, fx.d("2016-04-02"), 1)])
    root = f"{scratch}/wh2"
    first = load_warehouse(spark, inp, root)
    assert first["fact_sales"] == 1
    second = load_warehouse(spark, inp, root)
    assert set(second.values()) == {0}
    rej = spark.read.parquet(f"{root}/rejects/transactions_load").collect()
    assert [(r.order_id, r.reason) for r in rej] == [(2, "unknown_customer")]     # once, after two loads


def test_facts_and_rejects_read_the_joins_once(spark, scratch):
    inp = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [
        (1, 1, "P1", 1, fx.d("2016-04-02"), 0), (2, 9, "P1", 1, fx.d("2016-04-02"), 1), (3, 1, "P9", 1, fx.d("2016-04-02"), 2)])
    cal = dim_date(spark, *inp.calendar)
    want = [_rows(x, "order_id") for x in build_facts(inp, cal)]
    good, rejects = build_facts(inp, cal, f"{scratch}/joined")
    assert [_rows(x, "order_id") for x in (good, rejects)] == want == [[(1,)], [(2,), (3,)]]
    for df in (good, rejects):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    import glob
    from sparkmart.plans.etl import load_warehouse
    from sparkmart.session import checkpoint_root
    load_warehouse(spark, inp, f"{scratch}/wh_once")
    assert not glob.glob(checkpoint_root(spark).removeprefix("file:") + "/load-*")      # nothing is left behind


def test_a_table_that_is_missing_or_streamed_is_no_first_load(spark, scratch):
    """Facts that another loader wrote stay, whatever else the root lacks."""
    from sparkmart.plans.etl import load_warehouse
    root = f"{scratch}/wh3"
    one = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [(1, 1, "P1", 1, fx.d("2016-04-02"), 0)])
    star_rows(spark, one).fact_sales.withColumn("sale_year", F.lit(2016)).write.partitionBy("sale_year").parquet(f"{root}/fact_sales")
    two = fx.inputs(spark, [fx.cust_row(1)], [fx.prod_row("P1", 2.0, 0)], [(2, 1, "P1", 3, fx.d("2016-04-02"), 0)])
    assert load_warehouse(spark, two, root)["fact_sales"] == 1
    assert _rows(read_star(spark, root).fact_sales, "order_id") == [(1,), (2,)]


def test_insert_ignore_batch_agrees(spark):
    from sparkmart.operators.dedupe import first_by, insert_ignore, insert_ignore_batch
    stored = spark.createDataFrame([(1, "A"), (2, "B"), (9, "Z")], "order_id long, product_id string")
    batch = spark.createDataFrame([(1, "A", 5, 0), (2, "C", 6, 1), (2, "C", 7, 2), (3, "A", 8, 3)],
                                  "order_id long, product_id string, q int, r long") \
        .selectExpr("order_id", "product_id", "q", "struct(r) AS src_pos")
    keys, cols = ["order_id", "product_id"], ["order_id", "product_id", "q"]
    want = _rows(insert_ignore(batch, stored, keys, "src_pos", cols), "order_id", "product_id", "q")
    assert want == [(2, "C", 6), (3, "A", 8)]
    for lo, hi in ((1, 3), (None, None)):
        got = insert_ignore_batch(first_by(batch, keys, "src_pos", cols), stored, keys, (lo, hi))
        assert (_rows(got, "order_id", "product_id", "q") == want) == (lo is not None)
