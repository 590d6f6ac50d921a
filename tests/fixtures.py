"""Small invented inputs for unit tests (typed, like the cleaners' output)."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.plans.etl import Inputs

CUSTOMER_SCHEMA = ("customer_id bigint, gender string, age string, occupation string, "
                   "city_category string, stay_in_current_city_years string, "
                   "marital_status boolean, row long")
PRODUCT_SCHEMA = ("product_id string, product_category string, price double, store_id bigint, "
                  "store_name string, supplier_id bigint, supplier_name string, row long")
TX_SCHEMA = "order_id bigint, customer_id bigint, product_id string, quantity int, sale_date date, row long"


def _pos(df):
    return df.withColumn("src_pos", F.struct("row")).drop("row")


def customers(spark, rows):
    return _pos(spark.createDataFrame(rows, CUSTOMER_SCHEMA))


def products(spark, rows):
    return _pos(spark.createDataFrame(rows, PRODUCT_SCHEMA))


def transactions(spark, rows):
    return _pos(spark.createDataFrame(rows, TX_SCHEMA))


def d(text):
    return dt.date.fromisoformat(text)


def inputs(spark, cust, prod, tx, calendar=("2015-01-01", "2017-12-31")):
    return Inputs(customers(spark, cust), products(spark, prod), transactions(spark, tx), calendar)


def cust_row(cid, row=None, gender="M", age="26-35", occ="A", city="B", stay="1", married=False):
    return (cid, gender, age, occ, city, stay, married, row if row is not None else cid)


def prod_row(pid, price, row, store=1, store_name="S1", sup=1, sup_name="SUP1", cat="C1"):
    return (pid, cat, price, store, store_name, sup, sup_name, row)
