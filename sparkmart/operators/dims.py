"""Dimension rows and the product lookup, derived from typed master data.

The reference applies two different duplicate rules to one product file:
``dim_product`` keeps the first row per product (insert-if-absent), while
the in-memory lookup used for prices, stores and suppliers keeps the last
(dict overwrite).  Both are kept as separately named steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sparkmart.operators.dedupe import last_by
from sparkmart.sources.csv import POS

CUSTOMER_ATTRS = ["gender", "age", "occupation", "city_category",
                  "stay_in_current_city_years", "marital_status"]


def product_lookup(products: DataFrame) -> DataFrame:
    """Last row per product id: unrounded price, store and supplier ids."""
    return last_by(products, ["product_id"], POS,
                   ["product_id", "price", "store_id", "supplier_id"])


def extract_stores(products: DataFrame) -> DataFrame:
    """Distinct stores of the product master; the last name in file order wins."""
    return last_by(products, ["store_id"], POS, ["store_id", "store_name"])


def extract_suppliers(products: DataFrame) -> DataFrame:
    """Distinct suppliers of the product master; the last name wins."""
    return last_by(products, ["supplier_id"], POS, ["supplier_id", "supplier_name"])
