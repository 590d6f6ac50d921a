"""Replayed feeds: arrival is a column, so nothing has to wait or sleep."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkmart import schema
from sparkmart.operators.joins import enrich_product_as_of
from sparkmart.plans.etl import load_warehouse
from sparkmart.sources import csv as csv_src
from sparkmart.sources import warehouse as wh
from sparkmart.sources.calendar import dim_date
from sparkmart.sources.warehouse import read_table
from sparkmart.streaming import hybrid_join, jobs
from sparkmart.streaming.hybrid_join import WarehouseLoader, ensure_dim_date, preload_products
from tests import fixtures as fx

TX = "orderID string, Customer_ID string, Product_ID string, quantity string, date string, arrived string"
CUST = ("Customer_ID string, Gender string, Age string, Occupation string, City_Category string, "
        "Stay_In_Current_City_Years string, Marital_Status string, arrived string")
PROD = ("Product_ID string, Product_Category string, `price$` string, storeID string, storeName string, supplierID string, "
        "supplierName string, arrived string")


def tx(order, customer, arrived, product="P1", quantity=1):
    return str(order), str(customer), product, str(quantity), "2016-04-02", arrived


def cust(key, arrived, gender="M"):
    return str(key), gender, "26-35", "x", "A", "1", "0", arrived


def prod(key, price, arrived, store=1, name="S1"):
    return key, "C1", price, str(store), name, "1", "SUP1", arrived


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Feed:
    def __init__(self, spark, scratch, **options):
        self.spark, self.inbox, self.root, self.scratch = spark, f"{scratch}/inbox", f"{scratch}/wh", scratch
        self.options = {"ttl": "24 hours", "arrival": "arrived", **options}
        ensure_dim_date(spark, self.root, dim_date(spark, "2016-01-01", "2016-12-31"))

    def put(self, source, rows, columns):
        csv_src.write_text_parquet(self.spark.createDataFrame(rows, columns).coalesce(1), f"{self.inbox}/{source}", mode="append")

    def preload(self):
        fx.products(self.spark, [fx.prod_row("P1", 2.0, 0)]).write.parquet(f"{self.inbox}/products")

    def run(self):
        load = jobs.start_hybrid_load(self.spark, self.inbox, self.root, f"{self.scratch}/ckpt", **self.options)
        load.awaitTermination()
        return load

    def facts(self):
        return sorted((r.order_id, str(r.revenue)) for r in read_table(self.spark, self.root, "fact_sales").collect())

    def dead(self):
        return [r.order_id for r in self.spark.read.parquet(f"{self.root}/dead_letters").collect()]


def state_rows(load):
    """Rows in the join's state after each micro-batch that had input."""
    return [p["stateOperators"][0]["numRowsTotal"] for p in load.queries[1].recentProgress if p["numInputRows"]]


def test_only_misses_enter_the_state(spark, scratch):
    """The master is in the warehouse: 300 known customers stay out of the state."""
    feed = Feed(spark, scratch)
    feed.preload()
    known = fx.inputs(spark, [fx.cust_row(i) for i in range(1, 301)], [fx.prod_row("P1", 2.0, 0)], [])
    load_warehouse(spark, known, feed.root)
    feed.put("customers", [cust(900, "2016-01-01")], CUST)
    feed.put("transactions", [tx(i, i, "2016-01-01") for i in range(1, 101)] + [tx(501, 901, "2016-01-01"), tx(502, 902, "2016-01-01")], TX)
    assert state_rows(feed.run())[-1] == 2 + 1            # the two misses, and customer 900 until the clock moves on
    feed.put("transactions", [tx(503, 7, "2016-01-01 06:00:00")], TX)
    feed.run()
    feed.put("transactions", [tx(504, 7, "2016-01-09")], TX)
    feed.put("customers", [cust(902, "2016-01-01 20:00:00")], CUST)
    assert state_rows(feed.run())[-1] == 2 + 1            # waiting transactions and the customer that comes for one
    assert [o for o, _ in feed.facts()] == [*range(1, 101), 502, 503, 504]
    assert feed.dead() == [501]


def test_a_customer_sent_again_matches_once(spark, scratch):
    feed = Feed(spark, scratch, files_per_trigger=1)
    feed.preload()
    feed.put("customers", [cust(1, "2016-01-01", "F"), cust(1, "2016-01-01 01:00:00", "X")], CUST)
    feed.put("transactions", [tx(10, 1, "2016-01-01"), tx(20, 2, "2016-01-01 02:00:00")], TX)
    feed.run()
    # Sent twice in one file, then again; order 20 has waited, order 11 comes later.
    feed.put("customers", [cust(2, "2016-01-01 03:00:00", "F"), cust(2, "2016-01-01 04:00:00", "X"), cust(1, "2016-01-01 05:00:00", "X")], CUST)
    feed.run()
    feed.put("customers", [cust(2, "2016-01-01 06:00:00", "Y")], CUST)
    feed.put("transactions", [tx(11, 1, "2016-01-01 07:00:00", "PX"), tx(21, 2, "2016-01-01 07:00:00"), tx(21, 2, "2016-01-01 07:00:00")], TX)
    feed.run()
    assert feed.facts() == [(10, "2.00"), (20, "2.00"), (21, "2.00")]
    rejects = spark.read.parquet(f"{feed.root}/rejects/transactions_load").collect()
    assert [(r.order_id, r.reason) for r in rejects] == [(11, "unknown_product")]           # once, not once per customer row
    assert {r.customer_id: r.gender for r in read_table(spark, feed.root, "dim_customer").collect()} == {1: "F", 2: "F"}


def test_customers_too_late_expire_and_order_does_not_matter(spark, scratch):
    """Everything in one micro-batch: time decides, not the order of rows."""
    feed = Feed(spark, scratch, disorder="30 days")
    feed.preload()
    feed.put("customers", [cust(1, "2016-02-01 23:00:00"), cust(2, "2016-02-03"), cust(3, "2015-01-01"), cust(99, "2016-09-01")], CUST)
    feed.put("transactions", [tx(10, 1, "2016-02-01"), tx(20, 2, "2016-02-01"), tx(21, 2, "2016-02-02 12:00:00"), tx(30, 3, "2016-02-01"),
                              tx(40, 4, "2016-01-20")], TX)
    feed.run()
    assert [o for o, _ in feed.facts()] == [10, 21, 30]
    assert sorted(feed.dead()) == [20, 40]


def test_products_that_arrive_in_mid_stream(spark, scratch):
    feed = Feed(spark, scratch, files_per_trigger=1)
    feed.preload()
    feed.put("customers", [cust(1, "2016-01-01")], CUST)
    feed.put("product_updates", [prod("P2", "$1.00", "2016-01-01", 2, "S2")], PROD)
    feed.put("transactions", [tx(1, 1, "2016-01-02"), tx(2, 1, "2016-01-02", "P2"), tx(3, 1, "2016-01-02", "P3")], TX)
    feed.run()
    feed.put("product_updates", [prod("P1", "$5.00", "2016-01-05"), prod("P3", "7", "2016-01-05", 1, "renamed"), prod("P4", "nan", "2016-01-05")], PROD)
    # Order 4 arrived before the new price, order 5 after it.
    feed.put("transactions", [tx(4, 1, "2016-01-04"), tx(5, 1, "2016-01-06"), tx(6, 1, "2016-01-06", "P3", 2)], TX)
    feed.run()
    assert feed.facts() == [(1, "2.00"), (2, "1.00"), (4, "2.00"), (5, "5.00"), (6, "14.00")]
    assert {r.product_id: str(r.price) for r in read_table(spark, feed.root, "dim_product").collect()} == {
        "P1": "2.00", "P2": "1.00", "P3": "7.00"}                                            # the first price stays
    assert {r.store_id: r.store_name for r in read_table(spark, feed.root, "dim_store").collect()} == {1: "S1", 2: "S2"}
    assert [r.order_id for r in spark.read.parquet(f"{feed.root}/rejects/transactions_load").collect()] == [3]
    assert [r.Product_ID for r in spark.read.parquet(f"{feed.root}/rejects/products").collect()] == ["P4"]


def test_line_order_of_a_streamed_csv(spark, scratch):
    """Rows of one key follow the file's lines, whatever their values."""
    feed = Feed(spark, scratch, arrival=None, fmt="csv")
    rows = lambda rows, columns, name: csv_src.write_csv(
        spark.createDataFrame([r[:-1] for r in rows], columns.rsplit(",", 1)[0]).coalesce(1), f"{feed.inbox}/{name}", mode="append")
    rows([cust(1, "", "Z"), cust(1, "", "A")], CUST, "customers")
    rows([prod("P1", "$9.00", ""), prod("P1", "$3.00", ""), prod("P1", "$4.00", "")], PROD, "product_updates")
    rows([tx(1, 1, "", quantity=8), tx(1, 1, "", quantity=2), tx(1, 1, "", quantity=5)], TX, "transactions")
    feed.run()
    assert feed.facts() == [(1, "32.00")]                                                    # first order, last price
    assert [r.gender for r in read_table(spark, feed.root, "dim_customer").collect()] == ["Z"]
    assert [str(r.price) for r in read_table(spark, feed.root, "dim_product").collect()] == ["9.00"]


def test_repeated_facts_are_dropped_after_a_restart_too(spark, scratch):
    facts = lambda ids: spark.createDataFrame(
        [(i, 1, "P1", 20160402, 1, 1, 1, None) for i in ids], schema.FACT_SALES).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    out = lambda: sorted(r.order_id for r in spark.read.parquet(f"{scratch}/out").collect())
    run = lambda: jobs.dedupe_feed(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", 1).awaitTermination()
    facts([1, 2, 2, 3])
    facts([3, 4, 1])
    run()
    assert out() == [1, 2, 3, 4]
    run()
    facts([4, 5, 2])
    run()
    assert out() == [1, 2, 3, 4, 5]


def test_deduplication_within_a_time(spark, scratch):
    from sparkmart.operators.dedupe import dedupe_facts_stream
    stream = spark.readStream.schema("k long, at timestamp").parquet(scratch)
    with pytest.raises(ValueError):
        dedupe_facts_stream(stream, ["k"], within="1 hour")
    plan = dedupe_facts_stream(stream, ["k"], "at", "1 hour")._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan


def test_price_as_of_arrival(spark):
    versions = spark.sql("""SELECT * FROM VALUES ('P', TIMESTAMP '2016-01-01', 1, 1.0D, 1L, 1L), ('P', TIMESTAMP '2016-01-03', 1, 3.0D, 1L, 1L),
        ('P', TIMESTAMP '2016-01-03', 2, 4.0D, 2L, 1L) AS v(product_id, since, src_pos, price, store_id, supplier_id)""")
    at = spark.sql("SELECT * FROM VALUES ('P', TIMESTAMP '2015-12-31'), ('P', TIMESTAMP '2016-01-01'), ('P', TIMESTAMP '2016-01-04'), "
                   "('Q', TIMESTAMP '2016-01-04') AS t(product_id, arrival_ts)")
    got = {(r.product_id, str(r.arrival_ts)[:10]): (r.price, r.store_id) for r in enrich_product_as_of(at, versions).collect()}
    assert got == {("P", "2015-12-31"): (None, None), ("P", "2016-01-01"): (1.0, 1), ("P", "2016-01-04"): (4.0, 2), ("Q", "2016-01-04"): (None, None)}


def test_intake_is_bounded_by_bytes(spark, scratch):
    """One large and many small files: no micro-batch beyond the bound, but for a
    file that alone is larger."""
    import os
    rows = lambda n: [(str(i), "1", "P1", "1", "2016-04-02") for i in range(n)]
    columns = TX.rsplit(",", 1)[0]
    for n in [60] * 6 + [4000]:
        csv_src.write_csv(spark.createDataFrame(rows(n), columns).coalesce(1), f"{scratch}/in", mode="append")
    sizes = sorted(os.path.getsize(f"{scratch}/in/{f}") for f in os.listdir(f"{scratch}/in") if f.endswith(".csv"))
    bound = 2 * sizes[0] + 10
    seen = []
    stream = csv_src.read_transactions_stream(spark, f"{scratch}/in", max_bytes_per_trigger=str(bound))
    stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option(
        "checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 6 * 60 + 4000
    assert all(n <= 120 or n == 4000 for n in seen), seen
    with pytest.raises(ValueError):
        csv_src.read_transactions_stream(spark, scratch, max_files_per_trigger=1, max_bytes_per_trigger="1m")


def test_live_view_writes_what_changed(spark, scratch):
    days = dim_date(spark, "2016-01-01", "2016-12-31")
    stores = spark.createDataFrame([(i, f"S{i}") for i in range(40)], schema.DIM_STORE)
    put = lambda rows: spark.createDataFrame(
        [(o, 1, "P", d, s, 1, 1, Decimal(r)) for o, d, s, r in rows], schema.FACT_SALES).coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    def run():
        facts = spark.readStream.schema(schema.FACT_SALES).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
        jobs.start_live_view(facts, days, stores, f"{scratch}/out", f"{scratch}/ckpt").awaitTermination()
        return spark.read.parquet(f"{scratch}/out/changes")

    view = lambda: {(r.store_name, r.quarter): str(r.total_quarterly_sales) for r in jobs.read_live_view(spark, f"{scratch}/out").collect()}
    put([(i, 20160110, i, "1.00") for i in range(40)])
    assert run().count() == 40
    put([(100, 20160210, 3, "2.50"), (101, 20160710, 3, "4.00")])
    assert run().where("epoch = 1").count() == 2                  # of 41 groups
    assert len(view()) == 41 and view()[("S3", 1)] == "3.50" and view()[("S3", 3)] == "4.00" and view()[("S4", 1)] == "1.00"
    before = view()
    jobs.compact_live_view(spark, f"{scratch}/out")
    assert view() == before and spark.read.parquet(f"{scratch}/out/changes").count() == 41
    put([(102, 20160710, 4, "1.00")])
    run()
    assert view() == {**before, ("S4", 3): "1.00"}


def test_partitions_follow_the_feed(spark, scratch):
    """A small feed isn't dealt over all the partitions that the session has."""
    spark.range(100).write.parquet(f"{scratch}/inbox/transactions")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        session = jobs.feed_session(spark, f"{scratch}/inbox")
        assert int(session.conf.get("spark.sql.shuffle.partitions")) == spark.sparkContext.defaultParallelism
        assert wh.buckets(session, f"{scratch}/wh") == spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert jobs.feed_session(spark, f"{scratch}/inbox").conf.get("spark.sql.shuffle.partitions") == "2"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_inserts_do_not_compute_a_micro_batch_again(spark, scratch):
    """Rows joined with a dimension are computed once, though the load writes that dimension."""
    root, seen = f"{scratch}/wh", spark.sparkContext.accumulator(0)
    wh.write_table(spark, root, "dim_customer", fx.inputs(spark, [fx.cust_row(1)], [], []).customers)
    stored = wh.read_table(spark, root, "dim_customer").withColumnRenamed("customer_id", "c_customer_id")

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(1, 4).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("P1").alias("product_id"),
        counted.asNondeterministic()(F.lit(2)).alias("quantity"), F.lit(fx.d("2016-04-12")).alias("sale_date"),
        F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("id").alias("row")).alias("src_pos"),
        F.current_timestamp().alias("arrival_ts"), F.lit(True).alias("matched"))
    rows = rows.join(stored, F.col("customer_id") == F.col("c_customer_id")).withColumn("c_pos", F.col("src_pos"))
    ensure_dim_date(spark, root, dim_date(spark, "2016-01-01", "2016-12-31"))
    preload_products(spark, root, fx.inputs(spark, [], [fx.prod_row("P1", 2.0, 0)], []).products)
    WarehouseLoader(root)(rows, 0)
    assert wh.read_table(spark, root, "fact_sales").count() == 3 and seen.value == 3


def test_facts_are_sent_twice_in_one_file_without_a_shuffle(spark, scratch):
    rows = spark.range(40, numPartitions=4)
    jobs.write_twice(rows, f"{scratch}/twice")
    back = spark.read.parquet(f"{scratch}/twice").withColumn("file", F.input_file_name())
    assert {r["count"] for r in back.groupBy("id", "file").count().collect()} == {2} and back.count() == 80
    assert back.select("file").distinct().count() == 4


def test_a_micro_batch_is_parsed_and_stored_once(spark, scratch, monkeypatch):
    """Hits and misses come from one stored join, good and bad rows from one parse; a source without rejects writes none."""
    kept, clean = hybrid_join.kept, hybrid_join.Probe.CLEAN
    stored, parsed = [], spark.sparkContext.accumulator(0)
    monkeypatch.setattr(hybrid_join, "kept", lambda df: stored.append(1) or kept(df))

    @F.udf("string")
    def counted(x):
        parsed.add(1)
        return x

    counting = lambda raw, *a: clean["transactions"](raw.withColumn("orderID", counted.asNondeterministic()("orderID")), *a)
    monkeypatch.setattr(hybrid_join.Probe, "CLEAN", {**clean, "transactions": counting})
    feed = Feed(spark, scratch)
    feed.preload()
    feed.put("customers", [cust(1, "2016-01-01"), ("2", "M", "26-35", "x", "A", "1", "maybe", "2016-01-01")], CUST)
    feed.put("transactions", [tx(1, 1, "2016-01-01"), tx(2, 1, "2016-01-01", "PX"), tx(3, 9, "2016-01-01")], TX)
    feed.run()
    assert feed.facts() == [(1, "2.00")] and len(stored) == 1 and parsed.value == 3
    assert [r.order_id for r in spark.read.parquet(f"{feed.root}/rejects/transactions_load").collect()] == [2]
    assert [r.Customer_ID for r in spark.read.parquet(f"{feed.root}/rejects/customers").collect()] == ["2"]
    assert not wh.path_exists(spark, f"{feed.root}/rejects/transactions")


def test_a_replay_of_many_micro_batches_ends_every_transaction(spark, scratch, monkeypatch):
    """The clock reaches the feed's end with its last file, so what waits in later micro-batches expires too."""
    put = lambda name, rows, columns: spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")
    put("nation", [(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(0, "S", 0)], "s_suppkey long, s_name string, s_nationkey long")
    put("part", [(1, "T", 2.0), (7, "T", 3.0)], "p_partkey long, p_type string, p_retailprice double")
    put("customer", [(k, 0, "M") for k in (1, 9, 18)], "c_custkey long, c_nationkey long, c_mktsegment string")
    orders = [(i, (1, 9, 18)[i % 3], f"1996-{1 + i // 2:02d}-1{i % 2}") for i in range(24)]
    put("orders", orders, "o_orderkey long, o_custkey long, o_orderdate string")
    put("lineitem", [(i, 7 if i == 21 else 1, 1.0, 1, 0, "1996-01-01", 1.0) for i in range(24)],
        "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int, l_suppkey long, l_shipdate string, l_extendedprice double")
    monkeypatch.setattr(jobs, "FEED_ROWS", 1)
    monkeypatch.setattr(jobs, "BATCH_BYTES", 4000, raising=False)
    ended = {r.outcome: r.transactions for r in jobs.stream_replay_balance(spark, scratch).collect()}
    root = jobs.replayed(spark, scratch)
    epochs = spark.read.parquet(f"{root}/_misses").select("epoch").distinct().count()
    # Customer 1 comes in July 1996, 9 never, 18 after the year's end.
    early = sum(d < "1996-06-19" for _, c, d in orders if c == 1)
    assert epochs > 1 and ended == {"expired": 16 + early, "fact": 8 - early - 1, "rejected": 1}


def test_a_micro_batch_is_bounded_by_bytes_for_each_core(spark, scratch):
    """Nine small files of a feed are one micro-batch, not two of eight."""
    feed = Feed(spark, scratch, bytes_per_trigger=jobs.intake(spark))
    feed.preload()
    feed.put("customers", [cust(1, "2016-01-01")], CUST)
    for i in range(9):
        feed.put("transactions", [tx(i, 1, "2016-01-02")], TX)
    load = feed.run()
    assert len([p for p in load.queries[0].recentProgress if p["numInputRows"]]) == 1 and len(feed.facts()) == 9


def test_no_python_worker_starts_for_a_master_without_rows(spark, scratch):
    """A master that isn't there yet is an empty plan; an executor started a Python worker a core for it before."""
    for name, rows in ((hybrid_join.CUSTOMERS, hybrid_join.CUSTOMER_ROWS), (hybrid_join.PRODUCTS, hybrid_join.PRODUCT_ROWS)):
        empty = hybrid_join.stored_rows(spark, scratch, name, rows)
        plan = empty._jdf.queryExecution().executedPlan().toString()
        assert "LocalTableScan <empty>" in plan and empty.count() == 0
        assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in [*rows, *hybrid_join._PART]]


def test_a_micro_batch_takes_a_partition_of_the_feed_for_each_core(spark, scratch):
    """A feed of six times sf0.1 (47 MB) is one micro-batch; its files are counted without a join with the orders."""
    assert int(jobs.intake(spark)) >= spark.sparkContext.defaultParallelism * jobs.PARTITION_BYTES
    spark.range(100_000).withColumnRenamed("id", "l_orderkey").write.parquet(f"{scratch}/lineitem.parquet")
    assert jobs.feed_files(spark, scratch) == 100_000 // jobs.FEED_ROWS + 1


def test_lines_that_arrive_together_wait_as_one_row(spark, scratch):
    """Three lines of one order are one row of the state, a line that arrived later another; each ends by itself."""
    feed = Feed(spark, scratch)
    feed.preload()
    feed.put("customers", [cust(99, "2016-01-01")], CUST)
    feed.put("transactions", [tx(1, 5, "2016-01-01", p) for p in ("P1", "P2", "P1")] + [tx(2, 5, "2016-01-01 02:00:00"), tx(3, 6, "2016-01-01")], TX)
    assert state_rows(feed.run())[-1] == 3 + 1            # and customer 99
    feed.put("customers", [cust(5, "2016-01-01 12:00:00")], CUST)
    feed.run()
    assert feed.facts() == [(1, "2.00"), (2, "2.00")]
    assert [(r.order_id, r.product_id) for r in spark.read.parquet(f"{feed.root}/rejects/transactions_load").collect()] == [(1, "P2")]
    feed.put("transactions", [tx(4, 5, "2016-01-09")], TX)
    feed.run()
    assert feed.dead() == [3] and [o for o, _ in feed.facts()] == [1, 2, 4]


def test_waiting_rows_are_bounded(spark, monkeypatch):
    """Rows that arrive together wait in lists of LINES at most, and none gets lost."""
    monkeypatch.setattr(hybrid_join, "LINES", 10)
    at = F.lit("2016-01-01").cast("timestamp")
    rows = spark.range(95).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("P").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(fx.d("2016-01-01")).alias("sale_date"), at.alias("arrival_ts"), at.alias("wait_ts"),
        F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("id").alias("row")).alias("src_pos"))
    packed = hybrid_join.waiting_rows(rows).collect()
    assert max(len(r.lines) for r in packed) == 10 and sorted(x.order_id for r in packed for x in r.lines) == [*range(95)]


def test_a_large_micro_batch_is_dealt_like_the_buckets(spark, scratch, monkeypatch):
    """More rows than are looked up: first row per key, and keys that are stored stay as they are."""
    monkeypatch.setattr(hybrid_join, "FEW_ROWS", 0)
    feed = Feed(spark, scratch)
    feed.preload()
    feed.put("customers", [cust(i, "2016-01-01", "F") for i in (1, 2)], CUST)
    feed.put("transactions", [tx(1, 1, "2016-01-02", quantity=3), tx(1, 1, "2016-01-02", quantity=5), tx(2, 1, "2016-01-02")], TX)
    feed.run()
    feed.put("transactions", [tx(2, 1, "2016-01-03", quantity=7), tx(3, 2, "2016-01-03"), tx(4, 1, "2016-01-03")], TX)
    feed.run()
    assert feed.facts() == [(1, "6.00"), (2, "2.00"), (3, "2.00"), (4, "2.00")]
    assert sorted((r.customer_id, r.gender) for r in read_table(spark, feed.root, "dim_customer").collect()) == [(1, "F"), (2, "F")]


def test_no_row_of_a_micro_batch_is_cached(spark, scratch, monkeypatch):
    """What a batch needs again is stored with its columns packed; the executors held every raw and typed row before."""
    frame, cached = type(spark.range(1)), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: cached.append(df.columns) or persist(df, *a))
    feed = Feed(spark, scratch)
    feed.preload()
    feed.put("customers", [cust(1, "2016-01-01")], CUST)
    feed.put("transactions", [tx(1, 1, "2016-01-01"), tx(2, 9, "2016-01-01")], TX)
    feed.put("transactions", [tx(3, 1, "2016-01-09")], TX)
    feed.run()
    assert [o for o, _ in feed.facts()] == [1, 3] and feed.dead() == [2]
    assert not [c for c in cached if "src_pos" in c or "c_pos" in c]


def test_the_live_view_takes_many_small_files_at_once(spark, scratch):
    """The loaded facts have a file for each bucket and year; a micro-batch took sixteen of them."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    put = lambda name, rows, columns: spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")
    put("nation", [(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(0, "S", 0)], "s_suppkey long, s_name string, s_nationkey long")
    put("part", [(1, "T", 2.0)], "p_partkey long, p_type string, p_retailprice double")
    put("customer", [(1, 0, "M")], "c_custkey long, c_nationkey long, c_mktsegment string")
    put("orders", [(i, 1, f"{1990 + i % 8}-03-01") for i in range(160)], "o_orderkey long, o_custkey long, o_orderdate string")
    put("lineitem", [(i, 1, 1.0, 1, 0, "1996-01-01", 1.0) for i in range(160)],
        "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int, l_suppkey long, l_shipdate string, l_extendedprice double")
    view = {(r.year, r.quarter): str(r.total_quarterly_sales) for r in jobs.stream_store_quarterly(spark, scratch).collect()}
    assert view == {(1990 + y, 1): "40.00" for y in range(8)}
    base = wh.warehouse_root(spark, scratch, tag="stream")
    facts = read_table(spark, f"{base}/warehouse", "fact_sales")
    assert facts.select(F.input_file_name()).distinct().count() > 16
    assert spark.read.parquet(f"{base}/store_quarterly/changes").select("epoch").distinct().count() == 1
