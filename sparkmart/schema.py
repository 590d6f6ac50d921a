"""Schemas: raw CSV inputs (all text) and the star-schema tables.

Business keys (order, customer, store, supplier) are ``bigint``: the reference
declares ``int``, which overflows long before the target data volume.
``date_id`` stays ``int`` (a ``yyyymmdd`` smart key).
"""

from pyspark.sql import types as T

S = T.StringType()

# ---- raw inputs, read as text and cast with try_cast ------------------------
CUSTOMER_CSV = T.StructType([
    T.StructField("Customer_ID", S), T.StructField("Gender", S),
    T.StructField("Age", S), T.StructField("Occupation", S),
    T.StructField("City_Category", S),
    T.StructField("Stay_In_Current_City_Years", S),
    T.StructField("Marital_Status", S),
])

PRODUCT_CSV = T.StructType([
    T.StructField("Product_ID", S), T.StructField("Product_Category", S),
    T.StructField("price$", S), T.StructField("storeID", S),
    T.StructField("storeName", S), T.StructField("supplierID", S),
    T.StructField("supplierName", S),
])

TRANSACTION_CSV = T.StructType([
    T.StructField("orderID", S), T.StructField("Customer_ID", S),
    T.StructField("Product_ID", S), T.StructField("quantity", S),
    T.StructField("date", S),
])

# ---- star schema -----------------------------------------------------------
DIM_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("gender", S), T.StructField("age", S),
    T.StructField("occupation", S), T.StructField("city_category", S),
    T.StructField("stay_in_current_city_years", S),
    T.StructField("marital_status", T.BooleanType()),
])

DIM_STORE = T.StructType([
    T.StructField("store_id", T.LongType(), False),
    T.StructField("store_name", S),
])

DIM_SUPPLIER = T.StructType([
    T.StructField("supplier_id", T.LongType(), False),
    T.StructField("supplier_name", S),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_id", S, False),
    T.StructField("product_category", S),
    T.StructField("price", T.DecimalType(10, 2)),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("full_date", T.DateType()),
    T.StructField("day", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()), T.StructField("year", T.IntegerType()),
    T.StructField("weekday", S),
])

FACT_SALES = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", S, False),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("supplier_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("revenue", T.DecimalType(12, 2)),
])

# Primary keys (SQL DDL) and foreign keys fact -> dimension.
PRIMARY_KEYS = {
    "dim_customer": ["customer_id"],
    "dim_store": ["store_id"],
    "dim_supplier": ["supplier_id"],
    "dim_product": ["product_id"],
    "dim_date": ["date_id"],
    "fact_sales": ["order_id", "product_id"],
}
FOREIGN_KEYS = [
    ("customer_id", "dim_customer"),
    ("product_id", "dim_product"),
    ("date_id", "dim_date"),
    ("store_id", "dim_store"),
    ("supplier_id", "dim_supplier"),
]

STAR_TABLES = {
    "dim_customer": DIM_CUSTOMER, "dim_store": DIM_STORE,
    "dim_supplier": DIM_SUPPLIER, "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE, "fact_sales": FACT_SALES,
}

# Declared text lengths of the warehouse DDL (varchar(n) /
# char(n)).  Spark does not enforce them; quality.length_violations counts
# values that exceed them.
TEXT_LIMITS = {
    "dim_customer": {"gender": 10, "age": 10, "occupation": 50, "city_category": 1,
                     "stay_in_current_city_years": 5},
    "dim_store": {"store_name": 100},
    "dim_supplier": {"supplier_name": 100},
    "dim_product": {"product_id": 20, "product_category": 50},
    "dim_date": {"weekday": 10},
    "fact_sales": {"product_id": 20},
}

# Partition column of the stored fact table (derived from date_id).
FACT_PARTITION = "sale_year"
