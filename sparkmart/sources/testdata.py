"""Retail inputs derived from the TPC-H-style tables in ``/root/testdata``.

The warehouse needs three inputs: a customer master, a product master (with
price, store and supplier) and a transaction feed.  This module derives them
from ``customer``/``nation``, ``part``/``supplier``/``nation`` and
``lineitem``/``orders`` with DataFrame joins, already typed like the output
of the CSV cleaners, and can also render them in the reference's CSV text
layout (``$1,234.50`` prices, ``yyyy-MM-dd`` dates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.csv import POS

# Age band labels by customer key modulo 7 (invented bands).
AGE_BANDS = ["0-17", "18-25", "26-35", "36-45", "46-50", "51-55", "55+"]
# City category letter by region key; product key layout.
CITY_LETTERS = "ABCDE"
PRODUCT_KEY_FORMAT = "P%08d"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def calendar_range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day of the years that the orders span."""
    years = table(spark, sf_dir, "orders").select(F.year(F.to_date("o_orderdate")).alias("y"))
    lo, hi = years.agg(F.min("y"), F.max("y")).first()
    return f"{lo or 2000}-01-01", f"{hi or 2000}-12-31"


def product_key(col) -> F.Column:
    return F.format_string(PRODUCT_KEY_FORMAT, col)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is tiny; Catalyst's size estimate picks the broadcast.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    stay = (F.col("c_nationkey") % 5).cast("string")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
            .select(
                F.col("c_custkey").cast("bigint").alias("customer_id"),
                F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                F.element_at(F.array(*[F.lit(a) for a in AGE_BANDS]),
                             (F.col("c_custkey") % 7 + 1).cast("int")).alias("age"),
                F.col("c_mktsegment").alias("occupation"),
                F.substring(F.lit(CITY_LETTERS), F.col("n_regionkey") + 1, 1).alias("city_category"),
                F.when(stay == "4", "4+").otherwise(stay).alias("stay_in_current_city_years"),
                (F.col("c_custkey") % 3 == 0).alias("marital_status"),
                F.struct(F.col("c_custkey").alias("row")).alias(POS),
            ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part is sold by supplier ``p_partkey % count(supplier)`` through
    the store of that supplier's nation."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n_sup = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    linked = (part.withColumn("supplier_key", F.col("p_partkey") % n_sup)
              .join(sup, F.col("supplier_key") == sup.s_suppkey, "inner")
              .join(nat, F.col("s_nationkey") == nat.n_nationkey, "inner"))
    return linked.select(
        product_key("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("s_suppkey").cast("bigint").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.struct(F.col("p_partkey").alias("row")).alias(POS),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; the source position orders line items
    of one (order, part) by line number, then the remaining line columns."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        product_key("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.struct("l_linenumber", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice").alias(POS))
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("__order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.to_date("o_orderdate").alias("sale_date"))
    # Values are computed below the join: above it they would keep Catalyst from
    # moving a semi join by customer down to the orders.
    return (li.join(od, li.order_id == od["__order_id"], "inner")
            .select("order_id", "customer_id", "product_id", "quantity", "sale_date", POS))


# ---- reference CSV text layout --------------------------------------------

def customers_as_csv(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("customer_id").cast("string").alias("Customer_ID"),
        F.col("gender").alias("Gender"), F.col("age").alias("Age"),
        F.col("occupation").alias("Occupation"),
        F.col("city_category").alias("City_Category"),
        F.col("stay_in_current_city_years").alias("Stay_In_Current_City_Years"),
        F.col("marital_status").cast("int").cast("string").alias("Marital_Status"),
    )


def products_as_csv(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("product_id").alias("Product_ID"),
        F.col("product_category").alias("Product_Category"),
        F.concat(F.lit("$"), F.format_number("price", 2)).alias("price$"),
        F.col("store_id").cast("string").alias("storeID"),
        F.col("store_name").alias("storeName"),
        F.col("supplier_id").cast("string").alias("supplierID"),
        F.col("supplier_name").alias("supplierName"),
    )


def transactions_as_csv(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("order_id").cast("string").alias("orderID"),
        F.col("customer_id").cast("string").alias("Customer_ID"),
        F.col("product_id").alias("Product_ID"),
        F.col("quantity").cast("string").alias("quantity"),
        # The cast gives the same text for these years, without a formatter.
        F.when(F.col("sale_date").between("0001-01-01", "9999-12-31"), F.col("sale_date").cast("string"))
        .otherwise(F.date_format("sale_date", "yyyy-MM-dd")).alias("date"),
    )
