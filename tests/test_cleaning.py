"""Edge rows of the input contract: prices, keys, dates, quarantine."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.functions.parsing import parse_date, parse_price, to_long_key
from sparkmart.operators.clean import clean_customers, clean_products, clean_transactions


def _eval(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_price_formats(spark):
    got = _eval(spark, ["$1,234.50", "12.5", " $7 ", "1,234", "abc", "$abc"], parse_price)
    assert got == [1234.5, 12.5, 7.0, 0.0, 0.0, 0.0]


def test_price_missing_nan_inf_is_null(spark):
    assert _eval(spark, [None, "nan", "inf", "-Infinity", ""], parse_price) == [None] * 5


def test_float_looking_key(spark):
    assert _eval(spark, ["10", "10.0", " 10 ", "10.7", "x", None], to_long_key) == [10, 10, 10, 10, None, None]


def test_dates(spark):
    got = _eval(spark, ["2016-04-02", "2016-4-2", "4/2/2016", "2016-04-02 10:11:12", "nan"], parse_date)
    assert got == [dt.date(2016, 4, 2)] * 4 + [None]


def test_bad_orders_are_quarantined_with_reason(spark):
    raw = spark.createDataFrame(
        [("1", "10", "P1", "2", "2016-04-02", 0), ("x", "10", "P1", "2", "2016-04-02", 1),
         ("2", "10", "P1", "x", "2016-04-02", 2), ("3", None, "P1", "1", "2016-04-02", 3),
         ("4", "10.0", "P2", "1", "nan", 4)],
        "orderID string, Customer_ID string, Product_ID string, quantity string, date string, r long",
    ).withColumn("src_pos", F.struct("r")).drop("r")
    good, bad = clean_transactions(raw)
    assert [(r.order_id, r.customer_id) for r in good.collect()] == [(1, 10)]
    reasons = {r.orderID: r.reason for r in bad.collect()}
    assert reasons == {"x": "bad_order_id", "2": "bad_quantity", "3": "bad_customer_id", "4": "bad_date"}


def test_product_master_cleaning(spark):
    raw = spark.createDataFrame(
        [("P1", "C", "$1,234.50", "1", "S", "2", "U", 0), ("P2", "C", None, "1", "S", "2", "U", 1),
         ("P3", "C", "abc", "1", "S", "2", "U", 2), ("P4", "C", "5", "q", "S", "2", "U", 3)],
        "Product_ID string, Product_Category string, `price$` string, storeID string, "
        "storeName string, supplierID string, supplierName string, r long",
    ).withColumn("src_pos", F.struct("r")).drop("r")
    good, bad = clean_products(raw)
    assert sorted((r.product_id, r.price) for r in good.collect()) == [("P1", 1234.5), ("P3", 0.0)]
    assert sorted((r.Product_ID, r.reason) for r in bad.collect()) == [
        ("P2", "missing_price"), ("P4", "bad_store_id")]


def test_customer_marital_flag(spark):
    raw = spark.createDataFrame(
        [("1", "M", "26-35", "x", "A", "2", "1", 0), ("2", "F", None, "y", "B", "4+", "0", 1),
         ("z", "F", "0-17", "y", "B", "1", "0", 2)],
        "Customer_ID string, Gender string, Age string, Occupation string, City_Category string, "
        "Stay_In_Current_City_Years string, Marital_Status string, r long",
    ).withColumn("src_pos", F.struct("r")).drop("r")
    good, bad = clean_customers(raw)
    rows = sorted((r.customer_id, r.age, r.marital_status) for r in good.collect())
    assert rows == [(1, "26-35", True), (2, None, False)]
    assert [r.reason for r in bad.collect()] == ["bad_customer_id"]


def test_csv_columns_by_header_name(spark, scratch):
    from sparkmart.sources.csv import read_transactions_batch
    import os
    path = f"{scratch}/tx"
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write("date,extra,quantity,Product_ID,Customer_ID,orderID\n2016-04-02,z,3,P1,10.0,7\n")
    good, bad = clean_transactions(read_transactions_batch(spark, path))
    assert [(r.order_id, r.customer_id, r.product_id, r.quantity) for r in good.collect()] == [(7, 10, "P1", 3)]
    assert bad.count() == 0
