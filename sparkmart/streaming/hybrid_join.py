"""Streaming transaction -> customer join with a waiting TTL, and its loader.

A transaction waits for its customer's master row for up to ``ttl`` after its own
arrival, and meets it once.  Two streaming queries do this:

1. *Probe.*  Each micro-batch of transactions, customers and products first adds
   the master rows to the stored masters (a customer's first row, every version
   of a product), then joins its transactions with that snapshot, restricted to
   the batch's keys.  Matches are loaded at once.  Misses are written out.
2. *Wait.*  Misses and customers new to the master, read as two streams, meet in a
   stream-stream left outer join bounded from both sides:

       wait_ts - disorder <= customer's c_ts <= wait_ts + ttl

   A miss stays in the state store until its customer comes or the watermark
   passes ``wait_ts + ttl`` (then it comes out with a null customer: a dead
   letter); a customer is forgotten once no earlier miss can come.  The master
   itself is never in the state.

Arrival is processing time, or a column of the feed, which replays a stored feed
as it arrived.  Arrivals may be out of order, inside a source or between sources,
by at most ``disorder``; whatever comes later still waits from the watermark on,
and nothing is dropped as late.  The probe ends every micro-batch with a *tick* in
both folders, a row that only carries the clock, so an idle customer stream
doesn't stop expiry.  A match must also satisfy ``c_arrival_ts <= arrival_ts +
ttl``, whichever of the two queries finds it.

Files of a micro-batch appear at once (written aside, then renamed, as Spark does
in its own checkpoints), and only once: a replayed micro-batch finds them there.
Facts and dimensions are insert-if-absent, everything else is kept by epoch with
the reason why it is no fact, so a replay adds nothing and no row gets lost.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schema
from sparkmart.operators import dims
from sparkmart.operators.clean import REASON, clean_customers, clean_products, clean_transactions
from sparkmart.operators.dedupe import first_by, insert_ignore, insert_ignore_batch
from sparkmart.operators.joins import enrich_date, enrich_product_as_of, with_revenue
from sparkmart.plans.etl import FACT_COLS
from sparkmart.session import checkpoint_root
from sparkmart.sources.csv import POS, batch_position
from sparkmart.sources.warehouse import (
    buckets, empty_table, make_folder, path_exists, read_table, remove, rename, table_path, write_table,
)

DEFAULT_TTL = "24 hours"
DEFAULT_DISORDER = "1 second"
C_ARRIVAL = "c_arrival_ts"
#: Stored masters and misses under the warehouse root: <name>/feed=F/epoch=N.
CUSTOMERS, PRODUCTS, MISSES = "_customers", "_products", "_misses"
#: Rows of a micro-batch that are looked up in a stored table, as the small side; more are dealt like its buckets.
FEW_ROWS = 100_000
#: Since when a master row holds that was there before the stream.
ALWAYS = "TIMESTAMP '0001-01-01 00:00:00'"

_POS_TYPE = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
                          T.StructField("row", T.LongType())])
_ATTRS = [f for f in schema.DIM_CUSTOMER.fields if f.name in dims.CUSTOMER_ATTRS]
CUSTOMER_ROWS = T.StructType([T.StructField("c_customer_id", T.LongType()), *_ATTRS, T.StructField("c_pos", _POS_TYPE),
                              T.StructField(C_ARRIVAL, T.TimestampType()), T.StructField("c_ts", T.TimestampType()),
                              T.StructField("c_tick", T.BooleanType())])
#: Transactions that wait: those of one customer that arrived at one time and lie within
#: ``LINES`` rows of a file wait as one row, as they meet the same customer row or none.
LINES = 1000
_LINE = [T.StructField("order_id", T.LongType()), T.StructField("product_id", T.StringType()),
         T.StructField("quantity", T.IntegerType()), T.StructField("sale_date", T.DateType()), T.StructField("row", T.LongType())]
MISS_ROWS = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("file", T.StringType()),
                          T.StructField("block", T.LongType()), T.StructField("lines", T.ArrayType(T.StructType(_LINE))),
                          T.StructField("arrival_ts", T.TimestampType()), T.StructField("wait_ts", T.TimestampType()),
                          T.StructField("tick", T.BooleanType())])
PRODUCT_ROWS = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("since", T.TimestampType()),
                             T.StructField(POS, _POS_TYPE), T.StructField("price", T.DoubleType()),
                             T.StructField("store_id", T.LongType()), T.StructField("supplier_id", T.LongType())])
_PART = [T.StructField("feed", T.StringType()), T.StructField("epoch", T.LongType())]


def feed_name(checkpoint: str) -> str:
    """Name of a feed's folders: a checkpoint counts its own epochs."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def folder(root: str, name: str, feed: str, epoch: int | None = None) -> str:
    base = f"{table_path(root, name)}/feed={feed}"
    return base if epoch is None else f"{base}/epoch={epoch}"


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` to ``path`` so that it appears whole, unless it is there: a
    replay leaves what other queries may have read."""
    spark = df.sparkSession
    if path_exists(spark, path):
        return
    parent, name = path.rsplit("/", 1)
    aside = f"{parent}/.writing-{name}"
    df.write.mode("overwrite").parquet(aside)
    rename(spark, aside, path)


def stored_rows(spark: SparkSession, root: str, name: str, rows: T.StructType) -> DataFrame:
    """A stored master with ``feed`` and ``epoch``; empty while there is none."""
    sch = T.StructType([*rows.fields, *_PART])
    path = table_path(root, name)
    return spark.read.schema(sch).parquet(path) if path_exists(spark, path) else empty_table(spark, sch)


@contextmanager
def kept(df: DataFrame):
    """``df`` stored in the shared checkpoint folder while it is used.  A write to a
    table (or a refresh of it) drops every cached plan that reads the table, so a
    cache of rows that were joined with a dimension would not outlive the inserts
    into that dimension."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/batch-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


class Shelf:
    """Rows of one micro-batch that are needed more than once, stored in the shared
    checkpoint folder until it ends.  A cache on the executors would hold every row
    unpacked, its file's name included; stored columns are packed, and a reader
    takes those that it needs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.n = spark, f"{checkpoint_root(spark)}/shelf-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Shelf:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)

    def store(self, df: DataFrame, **values) -> tuple[DataFrame, dict]:
        """The rows as stored, and ``values`` (aggregates) observed on the way."""
        self.n += 1
        seen, path = Observation(), f"{self.path}/{self.n}"
        df.observe(seen, *[v.alias(k) for k, v in values.items()]).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get


# ------------------------------------------------------------------ waiting

def hybrid_join_stream(misses: DataFrame, customers: DataFrame, ttl: str = DEFAULT_TTL,
                       disorder: str = DEFAULT_DISORDER) -> DataFrame:
    """Left outer stream-stream join of waiting transactions (``MISS_ROWS``)
    with the customers that came after them (``CUSTOMER_ROWS``, one row per
    customer); one row comes out for each transaction, and ``matched`` tells hits
    from expired rows.  Ticks move the watermark and go no further."""
    # The filters read the watermark's column (no tick is that old), so they stay
    # above the operator that observes it.
    old = F.expr(ALWAYS)
    t = misses.withWatermark("wait_ts", disorder).where(~F.col("tick") | (F.col("wait_ts") < old))
    c = customers.withWatermark("c_ts", disorder).where(~F.col("c_tick") | (F.col("c_ts") < old))
    wait, slack = F.expr(f"INTERVAL {ttl}"), F.expr(f"INTERVAL {disorder}")
    cond = ((F.col("customer_id") == F.col("c_customer_id"))
            & (F.col("c_ts") <= F.col("wait_ts") + wait) & (F.col("c_ts") >= F.col("wait_ts") - slack)
            & (F.col(C_ARRIVAL) <= F.col("arrival_ts") + wait))
    # No row has an empty list; a plain explode would drop ticks for theirs below the watermark.
    met = t.drop("tick").join(c.drop("c_tick"), cond, "leftOuter").withColumn("line", F.explode_outer("lines"))
    return met.select("line.order_id", "customer_id", "line.product_id", "line.quantity", "line.sale_date",
                      F.struct("file", "block", F.col("line.row").alias("row")).alias(POS), "arrival_ts", "wait_ts",
                      *[f.name for f in CUSTOMER_ROWS if f.name != "c_tick"], F.col("c_customer_id").isNotNull().alias("matched"))


def waiting_rows(misses: DataFrame) -> DataFrame:
    """Transactions with ``wait_ts`` as ``MISS_ROWS``."""
    near = F.floor(F.col(f"{POS}.row") / LINES).alias("__near")
    packed = misses.groupBy("customer_id", "arrival_ts", "wait_ts", F.col(f"{POS}.file").alias("file"),
                            F.col(f"{POS}.block").alias("block"), near).agg(F.collect_list(F.struct(
                                "order_id", "product_id", "quantity", "sale_date", F.col(f"{POS}.row").alias("row"))).alias("lines"))
    return packed.withColumn("tick", F.lit(False)).select(*MISS_ROWS.names)


def waiting_stream(spark: SparkSession, root: str, feed: str, ttl: str, disorder: str) -> DataFrame:
    """The second query's rows: what the probe of this feed left waiting."""
    def read(name: str, rows: T.StructType) -> DataFrame:
        path = folder(root, name, feed)
        make_folder(spark, path)
        return spark.readStream.schema(rows).option("recursiveFileLookup", True).parquet(path)

    return hybrid_join_stream(read(MISSES, MISS_ROWS), read(CUSTOMERS, CUSTOMER_ROWS), ttl, disorder)


# ------------------------------------------------------------------ loading

class EpochWriter:
    """``foreachBatch`` sink: each micro-batch overwrites its own folder, so a
    replay adds nothing."""

    def __init__(self, root: str, name: str, tag: str = ""):
        self.path, self.tag = table_path(root, name), tag

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/epoch={self.tag}{epoch_id}")


DROPPED = ["order_id", "customer_id", "product_id", "quantity", "sale_date", "arrival_ts", POS, "reason"]


def insert_products(spark: SparkSession, root: str, products: DataFrame, order: str) -> None:
    """Product, store and supplier rows that are new to the dimensions; a
    product's first row stays."""
    for name, rows, keys in [
        ("dim_store", dims.extract_stores(products), ["store_id"]),
        ("dim_supplier", dims.extract_suppliers(products), ["supplier_id"]),
        ("dim_product", first_by(products.withColumn("price", F.col("price").try_cast("decimal(10,2)")), ["product_id"], order), ["product_id"]),
    ]:
        cols = [f.name for f in schema.STAR_TABLES[name].fields]
        write_table(spark, root, name, insert_ignore_batch(rows.select(*cols), read_table(spark, root, name), keys))


def preload_products(spark: SparkSession, root: str, products: DataFrame) -> None:
    """Load a product master before the stream starts (typed, with ``src_pos``).
    The lookup (last row per product) replaces what was preloaded before; the
    dimensions keep the rows they have."""
    insert_products(spark, root, products, POS)
    lookup = dims.product_lookup(products).withColumn("since", F.expr(ALWAYS)).withColumn(POS, F.lit(None).cast(_POS_TYPE))
    lookup.select(*PRODUCT_ROWS.names).write.mode("overwrite").parquet(folder(root, PRODUCTS, "preload", -1))


def add_products(spark: SparkSession, root: str, products: DataFrame, feed: str, epoch: int) -> None:
    """Product rows that arrive with the stream (typed, with ``src_pos`` and
    ``since``): new dimension rows, and versions.  ``dim_product`` keeps the first
    price; facts are priced by the version that held at their arrival."""
    insert_products(spark, root, products.withColumn("__order", F.struct("since", POS)), "__order")
    write_once(products.select(*PRODUCT_ROWS.names), folder(root, PRODUCTS, feed, epoch))


class WarehouseLoader:
    """``foreachBatch`` sink: joined micro-batch -> facts, the customers they
    matched, and every other row with the reason why it isn't a fact.

    Expired rows go to ``dead_letters``, rows with an unknown product, a date
    outside the calendar or too large a revenue to ``rejects/transactions_load``;
    both per epoch.  Matched rows insert their customer if absent (dimension
    before fact), then themselves, with insert-if-absent on (order_id,
    product_id).  One loader at a time works on a root (``lock``), so the two
    queries of a load can't both insert one key.
    """

    def __init__(self, root: str, tag: str = "", lock: threading.Lock | None = None):
        self.root, self.tag, self.lock = root.rstrip("/"), tag, lock or threading.Lock()

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        # The stateful plan runs once, though its rows are read several times below.
        with Shelf(batch.sparkSession) as shelf:
            rows, n = shelf.store(batch, hits=F.count_if("matched"), dead=F.count_if(~F.col("matched")))
            if n["dead"]:
                with self.lock:
                    self._expire(rows.where(~F.col("matched")), epoch_id)
            if n["hits"]:
                self.load(rows.where("matched"), epoch_id)

    def load(self, batch: DataFrame, epoch_id: int) -> None:
        """Load matched rows that are cheap to read again."""
        with kept(with_reason(self.priced(batch, batch))) as stored:
            self.insert(stored, epoch_id)

    def priced(self, batch: DataFrame, products: DataFrame) -> DataFrame:
        """Transactions with price, store, supplier, date and revenue; ``batch`` is
        read once.  ``products`` has the batch's ``product_id`` s and is cheap to read."""
        spark = batch.sparkSession
        versions = stored_rows(spark, self.root, PRODUCTS, PRODUCT_ROWS)
        versions = versions.join(products.select("product_id").distinct(), "product_id", "left_semi")
        cal = read_table(spark, self.root, "dim_date")
        return with_revenue(enrich_date(enrich_product_as_of(batch, versions), cal, how="left"))

    def insert(self, stored: DataFrame, epoch_id: int, known: DataFrame | None = None) -> None:
        """Write matched rows (``with_reason``) to their tables.  Their customers have
        one row each in ``known``, or else the rows have the attributes."""
        with self.lock:
            self._load(stored.sparkSession, stored, epoch_id, known)

    def _insert(self, spark, rows: DataFrame, name: str, key_range, n: int) -> None:
        """First row per key, then insert-if-absent against the stored table: a few
        rows are looked up in it, more are dealt like its buckets."""
        keys, cols = schema.PRIMARY_KEYS[name], [f.name for f in schema.STAR_TABLES[name].fields]
        stored, dealt = read_table(spark, self.root, name), buckets(spark, self.root)
        if dealt and n > FEW_ROWS:
            stored = stored.where(F.col(keys[0]).between(*key_range))
            write_table(spark, self.root, name, insert_ignore(rows, stored, keys, POS, cols, dealt))
            return
        first = first_by(rows, keys, POS, cols).persist()
        try:
            write_table(spark, self.root, name, insert_ignore_batch(first, stored, keys, key_range))
        finally:
            first.unpersist()

    def _expire(self, dead: DataFrame, epoch_id: int) -> None:
        dead = dead.withColumn("reason", F.lit("customer_not_seen_within_ttl")).select(*DROPPED)
        EpochWriter(self.root, "dead_letters", self.tag)(dead.orderBy("arrival_ts", POS), epoch_id)           # oldest first

    def _load(self, spark: SparkSession, tagged: DataFrame, epoch_id: int, known: DataFrame | None) -> None:
        # One small aggregate tells which outputs this batch has (watermark-
        # only batches often carry nothing but still run) and the key ranges.
        stats = {r["kind"]: r for r in tagged.groupBy(F.when(F.col("reason").isNull(), "fact").otherwise("reject").alias("kind")).agg(
            F.count(F.lit(1)).alias("n"), F.min("order_id").alias("o_lo"), F.max("order_id").alias("o_hi"),
            F.min("c_customer_id").alias("c_lo"), F.max("c_customer_id").alias("c_hi")).collect()}
        if "reject" in stats:
            EpochWriter(self.root, "rejects/transactions_load", self.tag)(
                tagged.where(F.col("reason").isNotNull()).select(*DROPPED), epoch_id)
        if "fact" not in stats:
            return
        # Only rows that become facts insert their customer.  A customer's rows are alike
        # for the most part: they are collapsed by hash before the first is chosen by sort.
        good, hit = tagged.where(F.col("reason").isNull()), stats["fact"]
        cust = good if known is None else known.join(good.select("c_customer_id").distinct(), "c_customer_id", "left_semi")
        cust = cust.select(F.col("c_customer_id").alias("customer_id"), *dims.CUSTOMER_ATTRS, F.col("c_pos").alias(POS)).distinct()
        self._insert(spark, cust, "dim_customer", (hit["c_lo"], hit["c_hi"]), hit["n"])
        self._insert(spark, good.select(*FACT_COLS, POS), "fact_sales", (hit["o_lo"], hit["o_hi"]), hit["n"])


def with_reason(priced: DataFrame) -> DataFrame:
    """Why a priced transaction is no fact, its customer aside."""
    return priced.withColumn("reason", F.when(F.col("price").isNull(), F.lit("unknown_product"))
                             .when(F.col("date_id").isNull(), F.lit("date_outside_calendar"))
                             .when(F.col("revenue").isNull(), F.lit("revenue_overflow")))


# ------------------------------------------------------------------ probing

def tagged_rows(stream: DataFrame, kind: str) -> DataFrame:
    """A source's raw rows as one struct, so that several sources make one stream."""
    raw = [c for c in stream.columns if c not in (POS, "arrival_ts")]
    return stream.select(F.lit(kind).alias("kind"), F.struct(*[F.col(f"`{c}`") for c in raw]).alias(kind), POS, "arrival_ts")


def tick_row(spark: SparkSession, rows: T.StructType, **values) -> DataFrame:
    """One row of ``rows`` with these values, the rest null, in one partition."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.fields])


class Probe:
    """``foreachBatch`` sink of the first query: raw rows of all sources.  What the
    cleaners reject is written by epoch if there is any."""

    CLEAN = {"transactions": clean_transactions, "customers": clean_customers, "products": clean_products}

    def __init__(self, root: str, feed: str, ttl: str, disorder: str, loader: WarehouseLoader):
        self.root, self.feed, self.loader = root.rstrip("/"), feed, loader
        self.ttl, self.disorder = F.expr(f"INTERVAL {ttl}"), F.expr(f"INTERVAL {disorder}")
        self.last = None                                     # (epoch, clock) of the epoch that this object has ended

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark, good, bad, tops = batch.sparkSession, {}, {}, Observation()
        rows, seen = batch_position(batch), None
        # The batch is read once for its transactions, and tells then what else it has.
        first = rows.observe(tops, *[F.max(F.when(F.col("kind") == kind, F.col("arrival_ts"))).alias(kind) for kind in self.CLEAN])
        with Shelf(spark) as shelf:
            for kind, clean in self.CLEAN.items():
                if seen is not None and seen[kind] is None:
                    continue
                found = {}

                def hold(tagged: DataFrame) -> DataFrame:
                    stored, values = shelf.store(tagged, bad=F.count_if(F.col(REASON).isNotNull()))
                    found.update(values)
                    return stored

                source = first if seen is None else rows
                good[kind], bad[kind] = clean(source.where(F.col("kind") == kind).select(f"{kind}.*", POS, "arrival_ts"), hold)
                seen = seen or tops.get
                if seen[kind] is None:
                    del good[kind]
                elif found["bad"]:                                    # a source without rejects writes none
                    EpochWriter(self.root, f"rejects/{kind}", self.loader.tag)(bad[kind], epoch_id)
            before = self.last[1] if self.last and self.last[0] == epoch_id - 1 else self._clock(spark, epoch_id)
            now = max([t for t in [before, *seen.values()] if t is not None], default=None)
            if now is None:
                return
            floor = F.lit(before).cast("timestamp") - self.disorder + F.expr("INTERVAL 1 millisecond")
            if "products" in good:
                add_products(spark, self.root, good["products"].withColumnRenamed("arrival_ts", "since"), self.feed, epoch_id)
            self._customers(spark, good.get("customers"), floor, now, epoch_id, shelf)
            self._transactions(spark, good.get("transactions"), floor, now, epoch_id, shelf)
            self.last = (epoch_id, now)

    def _clock(self, spark: SparkSession, epoch_id: int):
        """The latest arrival up to the epoch before."""
        path = folder(self.root, MISSES, self.feed, epoch_id - 1)
        if not path_exists(spark, path):
            return None
        return spark.read.schema(MISS_ROWS).parquet(path).where("tick").agg(F.max("wait_ts")).first()[0]

    def _master(self, spark: SparkSession, epoch_id: int) -> DataFrame:
        """Customers stored before this epoch, as ``CUSTOMER_ROWS``."""
        rows = stored_rows(spark, self.root, CUSTOMERS, CUSTOMER_ROWS)
        return rows.where(~F.col("c_tick") & ~((F.col("feed") == self.feed) & (F.col("epoch") >= epoch_id))).drop("feed", "epoch")

    def _customers(self, spark: SparkSession, good: DataFrame | None, floor, now, epoch_id: int, shelf: Shelf) -> None:
        """Store the customers that are new, one row each: the first."""
        path = folder(self.root, CUSTOMERS, self.feed, epoch_id)
        if path_exists(spark, path):
            return
        # The join's null checks run below the watermark: a tick has a key.
        out = tick_row(spark, CUSTOMER_ROWS, c_customer_id=-1, **{C_ARRIVAL: now}, c_ts=now, c_tick=True)
        if good is not None:
            first, keys = shelf.store(
                first_by(good.withColumn("__order", F.struct("arrival_ts", POS)).withColumnRenamed(POS, "c_pos")
                         .withColumnRenamed("arrival_ts", C_ARRIVAL).withColumnRenamed("customer_id", "c_customer_id"),
                         ["c_customer_id"], "__order"), lo=F.min("c_customer_id"), hi=F.max("c_customer_id"))
            new = insert_ignore_batch(first, self._master(spark, epoch_id), ["c_customer_id"], (keys["lo"], keys["hi"]))
            new = new.withColumn("c_ts", F.greatest(C_ARRIVAL, floor)).withColumn("c_tick", F.lit(False))
            out = out.unionByName(new.select(*CUSTOMER_ROWS.names))
        write_once(out, path)

    def known(self, spark: SparkSession, keys: DataFrame, epoch_id: int) -> DataFrame:
        """The stored customers of ``keys (customer_id)``, one row each: the
        masters of this and other feeds (first arrival), else ``dim_customer``.
        The keys are the small side, so the masters are not shuffled while
        Spark can broadcast them."""
        keys = keys.select(F.col("customer_id").alias("c_customer_id")).distinct()
        rows = stored_rows(spark, self.root, CUSTOMERS, CUSTOMER_ROWS).where(
            ~F.col("c_tick") & ~((F.col("feed") == self.feed) & (F.col("epoch") > epoch_id))).join(keys, "c_customer_id", "left_semi")
        rows = rows.withColumn("__order", F.struct(C_ARRIVAL, "c_pos"))
        mine = first_by(rows, ["c_customer_id"], "__order", ["c_customer_id", *dims.CUSTOMER_ATTRS, "c_pos", C_ARRIVAL])
        dim = read_table(spark, self.root, "dim_customer").withColumnRenamed("customer_id", "c_customer_id")
        dim = dim.join(keys, "c_customer_id", "left_semi").join(mine.select("c_customer_id"), "c_customer_id", "left_anti")
        dim = dim.withColumn("c_pos", F.lit(None).cast(_POS_TYPE)).withColumn(C_ARRIVAL, F.expr(ALWAYS))
        return mine.unionByName(dim.select(*mine.columns))

    def _transactions(self, spark: SparkSession, good: DataFrame | None, floor, now, epoch_id: int, shelf: Shelf) -> None:
        out = tick_row(spark, MISS_ROWS, customer_id=-1, arrival_ts=now, wait_ts=now, tick=True)
        path = folder(self.root, MISSES, self.feed, epoch_id)
        if good is None:
            return write_once(out, path)
        known, _ = shelf.store(self.known(spark, good.select("customer_id"), epoch_id), n=F.count(F.lit(1)))
        in_time = F.col(C_ARRIVAL) <= F.col("arrival_ts") + self.ttl
        # A transaction takes its customer's key along; the attributes go to the customers' table alone.
        probed = self.loader.priced(good, good).join(
            known.select("c_customer_id", C_ARRIVAL), (F.col("customer_id") == F.col("c_customer_id")) & in_time, "left")
        probed = with_reason(probed.withColumn("matched", F.col("c_customer_id").isNotNull())).drop(C_ARRIVAL, "price")
        with kept(probed) as probed:                                     # stored once, for the load and for the misses
            self.loader.insert(probed.where("matched"), epoch_id, known)
            misses = probed.where(~F.col("matched")).withColumn("wait_ts", F.greatest("arrival_ts", floor))
            write_once(out.unionByName(waiting_rows(misses)), path)


def ensure_dim_date(spark: SparkSession, root: str, calendar: DataFrame) -> None:
    """Populate the calendar only when the stored table is empty or absent."""
    if read_table(spark, root, "dim_date").isEmpty():
        write_table(spark, root, "dim_date", calendar)
