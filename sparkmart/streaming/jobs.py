"""Runnable streaming jobs over the test tables.

``stream_hybrid_join`` replays the transaction feed as files (the reference's
text columns, stored as Parquet) in date order, joins it to the customer master stream with the
waiting TTL, and loads the star through ``WarehouseLoader`` with an
``availableNow`` trigger (bounded by ``maxBytesPerTrigger``).
``stream_store_quarterly`` keeps the store/quarter revenue view current by
streaming the loaded fact files through a stateful aggregation.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schema
from sparkmart.operators.clean import clean_products
from sparkmart.operators.dedupe import dedupe_facts_stream
from sparkmart.plans.etl import FACT_COLS
from sparkmart.plans.inputs import csv_path
from sparkmart.sources import csv as csv_src
from sparkmart.sources import testdata, warehouse
from sparkmart.sources.calendar import dim_date as make_calendar
from sparkmart.streaming.hybrid_join import (
    DEFAULT_DISORDER, DEFAULT_TTL, EpochWriter, Probe, WarehouseLoader, ensure_dim_date, feed_name, preload_products, tagged_rows,
    waiting_stream,
)

FILES_PER_TRIGGER = 8
#: Rows of one file of the replayed feed.
FEED_ROWS = 250_000
#: Stored bytes of a feed for one partition of its state and one bucket of its tables.
PARTITION_BYTES = 16 << 20
#: Stored bytes of a feed that a micro-batch takes for each core.
BATCH_BYTES = 128 << 20
#: What waits is kept in RocksDB, within bounded memory, unless the session says otherwise:
#: Spark's default holds every waiting row on the executors' heap.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
               "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
               # Else every row put is looked up first, to count those that are new.
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
#: Stored bytes of one file of the facts that are sent again; a micro-batch takes ``FILES_PER_TRIGGER``.
FILE_BYTES = 64 << 20


def write_arrivals(spark: SparkSession, sf_dir: str, inbox: str) -> None:
    """Customer master, product master and the transaction feed (text
    columns in Parquet files).  The feed is range-partitioned by date into
    ``feed_files`` files, so files arrive roughly in date order; all rows of
    one (order, product) share a date and land in one file, in
    source-position order."""
    cust = testdata.customers(spark, sf_dir)
    csv_src.write_text_parquet(testdata.customers_as_csv(cust), f"{inbox}/customers")
    testdata.products(spark, sf_dir).write.mode("overwrite").parquet(f"{inbox}/products")
    transactions = testdata.transactions(spark, sf_dir)
    feed = (transactions
            .repartitionByRange(feed_files(spark, sf_dir), "sale_date", "order_id", "product_id")
            .sortWithinPartitions("sale_date", "order_id", "product_id", "src_pos"))
    csv_src.write_text_parquet(testdata.transactions_as_csv(feed), f"{inbox}/transactions")


def feed_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of the transaction feed, of about ``FEED_ROWS`` rows.  Line items are
    counted, from their files' footers, and not their join with the orders."""
    return testdata.table(spark, sf_dir, "lineitem").count() // FEED_ROWS + 1


def feed_session(spark: SparkSession, inbox: str) -> SparkSession:
    """A session whose shuffle partitions fit a stored feed: one for each
    ``PARTITION_BYTES`` and one for each core at least, and no more than the caller's
    session has.  Every micro-batch visits all partitions of the state and all
    buckets of the tables, however few rows it has, so their number follows the
    feed; it holds for the warehouse and the checkpoint that are laid out here."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fit = max(spark.sparkContext.defaultParallelism, warehouse.folder_bytes(spark, inbox) // PARTITION_BYTES + 1)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(min(most, fit)))
    return session


def intake(spark: SparkSession) -> str:
    """Bytes of a feed that a micro-batch takes: ``BATCH_BYTES`` for each core.  A
    micro-batch costs seconds before its first row, so a bound by files, however
    small they are, spends the time of a load on that."""
    return str(spark.sparkContext.defaultParallelism * BATCH_BYTES)


def start_hybrid_load(spark: SparkSession, inbox: str, root: str, checkpoint: str,
                      ttl: str = DEFAULT_TTL, files_per_trigger: int = FILES_PER_TRIGGER,
                      available_now: bool = True, processing_time: str | None = None,
                      fmt: str = "parquet", arrival: str | None = None, disorder: str = DEFAULT_DISORDER,
                      bytes_per_trigger: str | None = None):
    """Start the streaming load; returns a ``HybridLoad``.

    ``inbox`` holds arriving files in the raw text layout (``fmt`` = parquet or
    csv) in ``transactions/`` and ``customers/``, and the product master, loaded
    once before the stream: typed Parquet rows, or with csv a file or folder in
    the raw layout.  Product rows that come later arrive as files in
    ``product_updates/``, also in the raw layout.  Rows that the cleaners reject
    are written to ``rejects/<source>``.

    Each source's share of a micro-batch is bounded by ``files_per_trigger``, or by
    ``bytes_per_trigger`` if that is given.

    Arrival is processing time, or the feed's column ``arrival``; see
    ``hybrid_join`` for ``ttl`` and ``disorder``.  With ``available_now`` the two
    queries run one after the other, else side by side.

    The ticks keep both streams' watermarks in step, so the least of the two
    holds, and the queries run in a session of their own that says so; the
    caller's settings stay."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark = spark.newSession()
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    # The JVM interprets methods over 8,000 bytes; the parse and the load make such ones if
    # a whole stage becomes one.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None:
        for key, value in STATE_STORE.items():
            spark.conf.set(key, value)
    if fmt == "csv":
        base = csv_path(spark, inbox, "products")
        base = base if warehouse.path_exists(spark, base) else f"{inbox}/products"
        master, bad = (clean_products(csv_src.read_product_master(spark, base)) if warehouse.path_exists(spark, base)
                       else (None, None))
        if bad is not None:
            bad.write.mode("overwrite").parquet(f"{root}/rejects/products/epoch=preload")
    else:
        path = f"{inbox}/products"
        master = spark.read.parquet(path) if warehouse.path_exists(spark, path) else None
    if master is not None:
        preload_products(spark, root, master)
    sources = {"transactions": csv_src.read_transactions_stream, "customers": csv_src.read_customer_stream}
    if warehouse.path_exists(spark, f"{inbox}/product_updates"):
        sources["products"] = csv_src.read_product_stream
    folders = {"products": "product_updates"}
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        tagged_rows(read(spark, f"{inbox}/{folders.get(kind, kind)}", None if bytes_per_trigger else files_per_trigger,
                         fmt, arrival, bytes_per_trigger), kind)
        for kind, read in sources.items()])
    feed, lock = feed_name(checkpoint), threading.Lock()

    def start(rows: DataFrame, sink, name: str):
        writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/{name}")
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()

    probe = Probe(root, feed, ttl, disorder, WarehouseLoader(root, f"{feed}-", lock))
    wait = WarehouseLoader(root, f"{feed}-late-", lock)
    return HybridLoad([lambda: start(rows, probe, "probe"),
                       lambda: start(waiting_stream(spark, root, feed, ttl, disorder), wait, "wait")], in_turn=available_now)


class HybridLoad:
    """The queries of one streaming load: the probe, and what waits."""

    def __init__(self, starts, in_turn: bool):
        self.starts = list(starts)
        self.queries = [self.starts.pop(0)()]
        while self.starts and not in_turn:
            self.queries.append(self.starts.pop(0)())

    def awaitTermination(self) -> None:
        for q in self.queries:
            q.awaitTermination()
        while self.starts:
            self.queries.append(self.starts.pop(0)())
            self.queries[-1].awaitTermination()

    def processAllAvailable(self) -> None:
        for q in self.queries:
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def stream_hybrid_join(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """Facts loaded by the streaming job (run once per ``base`` folder)."""
    base = base or warehouse.warehouse_root(spark, sf_dir, tag="stream")
    root = f"{base}/warehouse"
    if not warehouse.exists(spark, base):
        write_arrivals(spark, sf_dir, f"{base}/inbox")
        session = feed_session(spark, f"{base}/inbox")
        ensure_dim_date(session, root, make_calendar(session, *testdata.calendar_range(session, sf_dir)))
        q = start_hybrid_load(session, f"{base}/inbox", root, f"{base}/checkpoints/load", bytes_per_trigger=intake(session))
        q.awaitTermination()
        warehouse.complete(spark, base)
    return warehouse.read_table(spark, root, "fact_sales").select(*FACT_COLS)


# ------------------------------------------------------- a replayed feed

#: The replay: customers come in ten classes, some late and one never, and every
#: customer row is sent again later; a fifth of the products change their price
#: in mid-feed and a seventh appear only then.
REPLAY_TTL = "30 days"
REPLAY_START, REPLAY_CHANGE, REPLAY_END = "1990-01-01", "1998-01-01", "2040-01-01"
CLASS_DAYS, RESENT_DAYS = 200, 50
#: Sources of the feed are not in step: one may be all there before another.
REPLAY_DISORDER = "5000 days"


def write_replay(spark: SparkSession, sf_dir: str, inbox: str) -> None:
    """The test tables as a feed with arrival times (column ``arrived``)."""
    first_day = testdata.calendar_range(spark, sf_dir)[0]
    key = F.col("Customer_ID").cast("long")
    came = F.date_add(F.lit(first_day).cast("date"), (key % 10 * CLASS_DAYS).cast("int"))
    cust = testdata.customers_as_csv(testdata.customers(spark, sf_dir)).where(key % 10 != 9)
    first = cust.withColumn("arrived", came.cast("string"))
    again = cust.withColumn("Gender", F.lit("X")).withColumn("arrived", F.date_add(came, RESENT_DAYS).cast("string"))
    csv_src.write_text_parquet(first.unionByName(again), f"{inbox}/customers")

    prod = testdata.products(spark, sf_dir)
    part = F.substring("product_id", 2, 8).cast("int")
    old = prod.where(part % 7 != 0)
    new = prod.where((part % 7 == 0) | (part % 5 == 0)).withColumn("price", F.when(part % 5 == 0, F.col("price") * 2).otherwise(F.col("price")))
    updates = (testdata.products_as_csv(old).withColumn("arrived", F.lit(REPLAY_START))
               .unionByName(testdata.products_as_csv(new).withColumn("arrived", F.lit(REPLAY_CHANGE))))
    csv_src.write_text_parquet(updates, f"{inbox}/product_updates")

    transactions = testdata.transactions(spark, sf_dir)
    feed = (transactions.repartitionByRange(feed_files(spark, sf_dir), "sale_date", "order_id", "product_id")
            .sortWithinPartitions("sale_date", "order_id", "product_id", "src_pos"))
    hour = F.make_interval(hours=(F.col("orderID").cast("long") % 24).cast("int"))
    csv_src.write_text_parquet(testdata.transactions_as_csv(feed).withColumn(
        "arrived", (F.col("date").cast("timestamp") + hour).cast("string")), f"{inbox}/transactions")
    # The clock moves to the end with the last file: an unreadable row.  Any earlier,
    # what comes after it would wait from the watermark on, and never expire.
    tick = spark.range(0, 1, 1, 1).select(*[F.lit("end of feed").alias(f.name) for f in schema.TRANSACTION_CSV.fields],
                                          F.lit(REPLAY_END).alias("arrived"))
    csv_src.write_text_parquet(tick, f"{inbox}/transactions", mode="append")


def replayed(spark: SparkSession, sf_dir: str) -> str:
    """Root of the warehouse that the replayed feed has loaded (once)."""
    base = warehouse.warehouse_root(spark, sf_dir, tag="replay")
    root = f"{base}/warehouse"
    if not warehouse.exists(spark, base):
        write_replay(spark, sf_dir, f"{base}/inbox")
        session = feed_session(spark, f"{base}/inbox")
        ensure_dim_date(session, root, make_calendar(session, *testdata.calendar_range(session, sf_dir)))
        q = start_hybrid_load(session, f"{base}/inbox", root, f"{base}/checkpoints/load", ttl=REPLAY_TTL,
                              arrival="arrived", disorder=REPLAY_DISORDER, bytes_per_trigger=intake(session))
        q.awaitTermination()
        warehouse.complete(spark, base)
    return root


def stream_replay_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the replayed feed: customers known or in time, prices as of arrival."""
    return warehouse.read_table(spark, replayed(spark, sf_dir), "fact_sales").select(*FACT_COLS)


def _dimension(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.read_table(spark, replayed(spark, sf_dir), name)
    return run


stream_replay_dim_customer = _dimension("dim_customer")
stream_replay_dim_product = _dimension("dim_product")


def stream_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of the replayed feed whose customer didn't come in time."""
    root = replayed(spark, sf_dir)
    return spark.read.parquet(f"{root}/dead_letters").select(
        "order_id", "customer_id", "product_id", "quantity", "sale_date", "arrival_ts", "reason")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of the replayed feed that met a customer but no product."""
    root = replayed(spark, sf_dir)
    return spark.read.parquet(f"{root}/rejects/transactions_load").select(
        "order_id", "customer_id", "product_id", "quantity", "sale_date", "arrival_ts", "reason")


def stream_replay_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction key of the feed ends in one way: how many of each."""
    keys = lambda df, outcome: df.select("order_id", "product_id").distinct().withColumn("outcome", F.lit(outcome))
    ends = (keys(stream_replay_facts(spark, sf_dir), "fact")
            .unionByName(keys(stream_expired(spark, sf_dir), "expired"))
            .unionByName(keys(stream_rejects(spark, sf_dir), "rejected")))
    return ends.groupBy("outcome").agg(F.count("*").alias("transactions"))


def stream_dedupe_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded facts sent three times, twice in one file and again in a later
    one, through the keyed deduplication of the stream."""
    base = warehouse.warehouse_root(spark, sf_dir, tag="dedupe")
    out = f"{base}/facts"
    if not warehouse.exists(spark, base):
        facts = warehouse.star_for(spark, sf_dir).fact_sales.select(*FACT_COLS)
        stored = warehouse.folder_bytes(spark, warehouse.table_path(warehouse.warehouse_root(spark, sf_dir), "fact_sales"))
        facts = facts.coalesce(max(spark.sparkContext.defaultParallelism, stored // FILE_BYTES + 1))
        write_twice(facts, f"{base}/inbox/1")
        facts.write.mode("overwrite").parquet(f"{base}/inbox/2")
        session = feed_session(spark, f"{base}/inbox")
        for _ in range(2):                    # the second run resumes from the checkpoint and finds nothing new
            dedupe_feed(session, f"{base}/inbox", out, f"{base}/checkpoints/dedupe").awaitTermination()
        warehouse.complete(spark, base)
    return spark.read.parquet(out).select(*FACT_COLS)


def write_twice(facts: DataFrame, path: str) -> None:
    """Every row twice in one file, without a shuffle."""
    copies = facts.withColumn("__copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("__copy")
    copies.write.mode("overwrite").parquet(path)


def dedupe_feed(spark: SparkSession, inbox: str, out: str, checkpoint: str, files_per_trigger: int = FILES_PER_TRIGGER):
    """Start the deduplication of arriving fact files into ``out`` (a file sink,
    which commits each micro-batch once)."""
    facts = (spark.readStream.schema(schema.FACT_SALES).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", files_per_trigger).parquet(inbox))
    return (dedupe_facts_stream(facts, schema.PRIMARY_KEYS["fact_sales"]).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def live_store_quarterly(facts: DataFrame, dim_date: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Streaming aggregate: store_name, year, quarter, total_quarterly_sales.

    Facts arrive as a stream; the calendar (bounded) and stores are static
    lookups.  Partial sums per (store, date) are exact decimals, so update
    and complete output modes agree.
    """
    cal = F.broadcast(dim_date.select("date_id", "year", "quarter"))
    return (facts.join(cal, "date_id", "inner")
            .join(dim_store.select("store_id", "store_name"), "store_id", "inner")
            .groupBy("store_name", "year", "quarter")
            .agg(F.sum("revenue").cast("decimal(22,2)").alias("total_quarterly_sales")))


VIEW_KEYS = ["store_name", "year", "quarter"]


def start_live_view(facts: DataFrame, dim_date: DataFrame, dim_store: DataFrame, out: str, checkpoint: str):
    """Keep the store view current: each micro-batch adds the groups that it has
    changed, with their new totals, under its own epoch (a replay writes the
    same folder again).  What is written follows the changes, not the view."""
    changed = live_store_quarterly(facts, dim_date, dim_store)
    return (changed.writeStream.outputMode("update").foreachBatch(EpochWriter(out, "changes"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_live_view(spark: SparkSession, out: str) -> DataFrame:
    """The view as of the last epoch: the latest total of each group (a partial
    aggregate over the changes)."""
    changes = spark.read.parquet(f"{out}/changes")
    last = changes.groupBy(*VIEW_KEYS).agg(F.max(F.struct("epoch", "total_quarterly_sales")).alias("last"))
    return last.select(*VIEW_KEYS, "last.total_quarterly_sales")


def compact_live_view(spark: SparkSession, out: str) -> None:
    """Fold all changes into one folder (between runs of the view's query).  The
    folded rows keep the last epoch, so a replay of that epoch gives the same."""
    path = f"{out}/changes"
    changes = spark.read.parquet(path)
    top = changes.agg(F.max("epoch")).first()[0]
    folded = f"{out}/.folded-{top}"
    read_live_view(spark, out).write.mode("overwrite").parquet(f"{folded}/epoch={top}")
    warehouse.rename(spark, path, f"{out}/.before-{top}")
    warehouse.rename(spark, folded, path)


def stream_store_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream_hybrid_join(spark, sf_dir)  # make sure the streamed warehouse exists
    base = warehouse.warehouse_root(spark, sf_dir, tag="stream")
    root = f"{base}/warehouse"
    out = warehouse.table_path(base, "store_quarterly")
    if not warehouse.exists(spark, out + "_done"):
        fact_schema = T.StructType(schema.FACT_SALES.fields
                                   + [T.StructField(schema.FACT_PARTITION, T.IntegerType())])
        session = feed_session(spark, f"{base}/inbox")
        # By bytes: the facts have a file for each bucket, year and epoch of their load.
        facts = (session.readStream.schema(fact_schema).option("maxBytesPerTrigger", intake(session))
                 .parquet(warehouse.table_path(root, "fact_sales")))
        dims = {n: warehouse.read_table(session, root, n) for n in ("dim_date", "dim_store")}
        start_live_view(facts, dims["dim_date"], dims["dim_store"], out, f"{base}/checkpoints/store_quarterly").awaitTermination()
        warehouse.complete(spark, out + "_done")
    return read_live_view(spark, out)
