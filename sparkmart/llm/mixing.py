"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target number of words; a source whose target exceeds its
size is passed over again, in at most ``passes`` passes.  Documents of a source
queue in a shuffled order (a hash of the id), pass after pass, and each
gets the virtual time at which it finishes: cumulative words of its source,
divided by the source's share of the total.  All queues are merged by virtual
finish time and the merged order is cut at the total budget, where every
source has been served its target.

Running sums are distributed: rows carry a hash bucket that follows the
order, buckets are summed first, and only (source, bucket) and time-bucket
sums go through a window; within a bucket the sum is local.  A source with a
third of all rows is spread over all buckets.

Edge cases: null and empty texts have size 0, are never a reason to cut, and
take 0 words; a null source is a source of its own, last in order; repeated
rows (equal doc_id) are documents of their own in an order made whole by
their text's hash, and share one result row each; an empty table or a corpus
without words gives targets of 0; other columns are ignored by ``mix`` and
carried by ``stage``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm._common import stored, workspace

PASSES = 3
WEIGHTS = (1, 2, 3)
#: Rows of one bucket's local running sum.
BUCKET_ROWS = 50_000
SEED = 11


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Sources by code point, null last, take ``weights`` in turn and share the
    total; a target stops at ``passes`` times its source's size, and the excess
    is shared by weight among the rest until no target is above.  In order of
    size per weight, the capped sources are a prefix, so the level is found by
    two running sums over the per-source rows.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.col("place") % len(weights)).cast("double"))
    per = per.withColumn("cap", (F.col("source_size") * passes).cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Were this source the first that isn't capped, the level would be:
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
             / F.sum("weight").over(rest))
    per = per.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    first = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "place", "level"))).over(whole)
    per = per.withColumn("level", first["level"])
    return per.select("source", "source_size",
                      F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def queued(docs: DataFrame, weights=WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``doc_id, row, source_size, target, size, copies``: how many times the
    mix takes each row.  ``row`` tells rows with equal ids apart."""
    spark = docs.sparkSession
    path = workspace(spark, "mixing")
    sized = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.lit(SEED), "doc_id", "text", "source").alias("row"), n_words(F.col("text")).alias("size")), f"{path}/sized")
    goal = targets(sized, weights, passes)
    rows, total = sized.agg(F.count(F.lit(1)), F.sum("size")).first()
    buckets = max(1, rows * passes // BUCKET_ROWS)
    goal = stored(goal, f"{path}/targets")

    # Equal rows (same id, text and source) queue as one entry of many.
    entry = sized.groupBy("doc_id", "source", "row", "size").agg(F.count(F.lit(1)).alias("many"))
    entry = entry.withColumn("key", F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 1), "doc_id", "row"), 1))
    entry = entry.withColumn("bucket", F.shiftright(F.shiftright("key", 31) * buckets, 32))
    sums = entry.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("many")).alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before")).alias("s")
            .join(goal.alias("g"), F.expr("s.source <=> g.source"))
            .select("s.source", "s.bucket", "s.before", "g.source_size", "g.target"))
    local = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    with_sum = (entry.withColumn("upto", F.sum(F.col("size") * F.col("many")).over(local)).alias("e")
                .join(sums.alias("s"), F.expr("e.source <=> s.source and e.bucket = s.bucket"))
                .select("e.doc_id", "e.row", "e.size", "e.many", "e.key", "s.source_size", "s.target",
                        (F.col("upto") + F.col("before")).alias("upto")))
    # One row for each copy of each pass that may come before the source's target.
    copies = (with_sum.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("many").cast("int"))))
              .withColumn("served", F.col("pass") * F.col("source_size") + F.col("upto")
                          - (F.col("many") - F.col("copy")) * F.col("size")))
    share = F.col("target") / F.lit(float(total or 1))
    copies = copies.where("target > 0").withColumn("finish", F.col("served") / share)
    copies = copies.where(F.col("served") - F.col("size") < F.col("target"))
    # Merge all queues by virtual finish time and cut the order at the budget.
    steps = max(1, rows // BUCKET_ROWS) * 4
    merged = copies.withColumn("slot", F.least(F.floor(F.col("finish") / F.lit(float(total or 1)) * steps), F.lit(2 * steps)))
    slots = merged.groupBy("slot").agg(F.sum("size").alias("words"))
    slots = slots.select("slot", F.coalesce(F.sum("words").over(
        Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("slot").orderBy("finish", "key", "doc_id", "row", "pass", "copy").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    taken = (merged.withColumn("upto", F.sum("size").over(inside)).join(slots, "slot")
             .where(F.col("upto") + F.col("before") <= F.lit(total or 0)))
    taken = taken.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("copies"))
    # Copies of equal rows are dealt out evenly among them.
    out = (with_sum.alias("w").join(taken.alias("t"), F.expr("w.doc_id <=> t.doc_id and w.row = t.row"), "left")
           .select("w.*", F.coalesce("copies", F.lit(0)).alias("all_copies"))
           .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("many").cast("int"))))
           .withColumn("copies", F.floor((F.col("all_copies") + F.col("many") - F.col("nth")) / F.col("many"))))
    return out.select("doc_id", "row", "nth", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"))


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Mix all documents to the default weights: words taken of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return queued(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix itself.  A document that the mix takes more than
    once is there as many times; one that it doesn't take is gone."""
    row = F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), "text", F.col("source").cast("string"))
    want = queued(docs).where("copies > 0").select("doc_id", "row", "nth", "copies")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                        F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"))
    inner = inner.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "row").orderBy(F.lit(0))))
    both = inner.alias("a").join(want.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.row = b.row and a.nth = b.nth"))
    return both.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("d.*")
