"""Product affinity: the k product pairs bought together most often.

Semantics: pairs of fact rows with the same customer and date and ``product_a
< product_b``, counted per (product_a, product_b), top k by count.  Ties at
the cut are broken by product_a, product_b ascending.

One exact plan for baskets of any size, in which no basket is paired in full:

1. Fact rows are collapsed to (customer, date, product, c) once and stored as
   Parquet in the shared folder, so that each later step reads its columns; a
   pair's count is the sum over baskets of ``c_a * c_b``.
2. The ``HEADS`` products with most rows are paired with each other.  The k-th
   best of these exact counts, with its products, is a bound (tau, A, B):
   a pair matters only if its count is above tau, or equals tau and the pair
   comes before (A, B).
3. A pair's count is at most ``min(n_a * m_b, n_b * m_a)`` (n = rows of a
   product, m = most of it in one basket).  Products, then pairs, whose bound
   can't matter are dropped before and inside the basket join.  If all can,
   as the least sold product's n is above tau, baskets aren't dealt by product.
4. If fewer than k pairs with a count of two or more exist, pairs counted once
   fill up: such a pair has at most 2k - 2 smaller pairs in its basket, so the
   2k smallest products of every basket are enough (``row_number() <= 2k``, a
   partial window group limit).  A pair found there that step 3 doesn't know
   has a count of exactly one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import checkpoint_root

BASKET = ["customer_id", "date_id"]
#: Best-selling products that are paired in full to find the bound.
HEADS = 50


def basket_products(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*BASKET, "product_id").agg(F.count(F.lit(1)).alias("c"))


def _sides(bp: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    return tuple(bp.select(*BASKET, F.col("product_id").alias(f"product_{x}"), F.col("c").alias(f"c{x}"),
                           *[F.col(e).alias(f"{e}_{x}") for e in extra]) for x in "ab")


def _count(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("product_a", "product_b").agg(
        F.sum(F.col("ca") * F.col("cb")).cast("long").alias("together_count"))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    return (pairs.orderBy(F.desc("together_count"), "product_a", "product_b").limit(k)
            .select("product_a", "product_b", "together_count"))


def top_pairs(fact: DataFrame, k: int = 5, heads: int = HEADS) -> DataFrame:
    """Top-k pairs by (count desc, product_a, product_b), exact."""
    spark = fact.sparkSession
    path = f"{checkpoint_root(spark)}/affinity-{uuid.uuid4().hex}"
    basket_products(fact).write.parquet(f"{path}/baskets")
    bp = spark.read.parquet(f"{path}/baskets")
    bp.groupBy("product_id").agg(F.sum("c").alias("n"), F.max("c").alias("m")).write.parquet(f"{path}/products")
    stats = spark.read.parquet(f"{path}/products")
    some = stats.orderBy(F.desc("n"), "product_id").limit(heads).select("product_id")
    a, b = _sides(bp.join(F.broadcast(some), "product_id", "left_semi"))
    known = _best(_count(a.join(b, BASKET).where("product_a < product_b")), k).collect()    # k rows
    full = len(known) == k
    tau, last = (known[-1].together_count, (known[-1].product_a, known[-1].product_b)) if full else (1, None)
    least = max(tau, 2)

    def matters(bound: Column, pair: Column | None = None) -> Column:
        """Whether a pair with at most ``bound`` can be in the answer."""
        if not full or tau < 2:
            return bound >= least
        return (bound > tau) | ((bound == tau) & pair)

    fewest, most = stats.agg(F.min("n"), F.coalesce(F.max("m"), F.lit(0))).first()
    if fewest is None or fewest > max(tau, 1):
        # Every bound is above the k-th count: no product and no pair would be dropped.
        a, b = _sides(bp)
        joined = a.join(b, BASKET).where("product_a < product_b")
    else:
        rows = bp.join(stats, "product_id")
        a, b = _sides(rows, "n", "m")
        if full:
            a = a.where(matters(F.col("n_a") * most, F.col("product_a") <= last[0]))
        else:
            a = a.where(matters(F.col("n_a") * most))
        b = b.where(F.col("n_b") * most >= least)
        bound = F.least(F.col("n_a") * F.col("m_b"), F.col("n_b") * F.col("m_a"))
        before = F.struct("product_a", "product_b") <= F.struct(*[F.lit(x) for x in last]) if full else None
        joined = a.join(b, BASKET).where((F.col("product_a") < F.col("product_b")) & matters(bound, before))
    high = _count(joined).where(F.col("together_count") >= least)
    if tau >= 2:
        return _best(high, k)
    # The best k are stored; if they are fewer, they are all there are.
    _best(high, k).write.parquet(f"{path}/high")
    high = spark.read.parquet(f"{path}/high")
    if high.count() == k:
        return _best(high, k)
    smallest = Window.partitionBy(*BASKET).orderBy("product_id")
    firsts = bp.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= 2 * k)
    a, b = _sides(firsts)
    once = (a.join(b, BASKET).where("product_a < product_b").select("product_a", "product_b").distinct()
            .join(high, ["product_a", "product_b"], "left_anti").withColumn("together_count", F.lit(1).cast("long")))
    return _best(high.unionByName(once), k)
