"""Typing and validation of raw input rows (text -> typed + reject reason).

Each cleaner returns ``(good, rejects)``.  Both are filters over one tagged
projection, so Spark evaluates the casts once per scan; ``rejects`` carries
the raw text plus a ``reason`` column and replaces the reference's silent
drops (or aborts) with a quarantine output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.parsing import (
    parse_date, parse_flag, parse_price, text_or_null, to_int, to_long_key,
)
from sparkmart.sources.csv import POS

REASON = "reason"


def _first_reason(checks) -> F.Column:
    expr = None
    for cond, label in checks:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def _split(raw: DataFrame, typed: dict[str, F.Column], checks, keep=(), hold=None) -> tuple[DataFrame, DataFrame]:
    # The raw text travels as one struct: its names may differ from the typed
    # ones only by case, which Spark's resolver would find ambiguous.
    raw_cols = [c for c in raw.columns if c != POS and c not in keep]
    tagged = raw.select(
        F.struct(*[F.col(f"`{c}`") for c in raw_cols]).alias("__raw"),
        *[F.col(c) for c in keep], *[expr.alias(name) for name, expr in typed.items()],
        F.col(POS),
    )
    tagged = tagged.withColumn(REASON, _first_reason([
        (F.col(c[0]).isNull() & (F.trim(F.col(f"__raw.`{c[2]}`")) != "") if len(c) > 2 else F.col(c[0]).isNull(), c[1])
        for c in checks]))
    if hold:                                                 # what is stored has the raw text of rejects only
        tagged = hold(tagged.withColumn("__raw", F.when(F.col(REASON).isNotNull(), F.col("__raw"))))
    good = tagged.where(F.col(REASON).isNull()).select(*typed, *keep, POS)
    bad = tagged.where(F.col(REASON).isNotNull()).select("__raw.*", POS, REASON)
    return good, bad


def clean_transactions(raw: DataFrame, hold=None) -> tuple[DataFrame, DataFrame]:
    """orderID, Customer_ID, quantity -> integers; Product_ID -> text;
    date -> date.  A row failing any of them is rejected."""
    keep = [c for c in ("arrival_ts",) if c in raw.columns]
    typed = {
        "order_id": to_long_key("orderID"),
        "customer_id": to_long_key("Customer_ID"),
        "product_id": text_or_null("Product_ID"),
        "quantity": to_int("quantity"),
        "sale_date": parse_date("date"),
    }
    checks = [("order_id", "bad_order_id"), ("customer_id", "bad_customer_id"),
              ("product_id", "missing_product_id"), ("quantity", "bad_quantity"),
              ("sale_date", "bad_date")]
    return _split(raw, typed, checks, keep, hold)


def clean_customers(raw: DataFrame, hold=None) -> tuple[DataFrame, DataFrame]:
    """Customer_ID -> integer key (row rejected if unreadable); the text
    attributes are trimmed (missing -> NULL); Marital_Status -> boolean
    (missing -> NULL, unreadable -> rejected)."""
    keep = [c for c in ("arrival_ts",) if c in raw.columns]
    typed = {
        "customer_id": to_long_key("Customer_ID"),
        "gender": text_or_null("Gender"),
        "age": text_or_null("Age"),
        "occupation": text_or_null("Occupation"),
        "city_category": text_or_null("City_Category"),
        "stay_in_current_city_years": text_or_null("Stay_In_Current_City_Years"),
        "marital_status": parse_flag("Marital_Status"),
    }
    checks = [("customer_id", "bad_customer_id"), ("marital_status", "bad_marital_status", "Marital_Status")]
    return _split(raw, typed, checks, keep, hold)


def clean_products(raw: DataFrame, hold=None) -> tuple[DataFrame, DataFrame]:
    """Product_ID text key, ``price$`` parsed (``$1,234.50`` form), store and
    supplier ids as integers.  Missing/NaN/inf price, or an unreadable key,
    rejects the row."""
    keep = [c for c in ("arrival_ts",) if c in raw.columns]
    typed = {
        "product_id": text_or_null("Product_ID"),
        "product_category": text_or_null("Product_Category"),
        "price": parse_price("`price$`"),
        "store_id": to_long_key("storeID"),
        "store_name": text_or_null("storeName"),
        "supplier_id": to_long_key("supplierID"),
        "supplier_name": text_or_null("supplierName"),
    }
    checks = [("product_id", "missing_product_id"), ("price", "missing_price"),
              ("store_id", "bad_store_id"), ("supplier_id", "bad_supplier_id")]
    return _split(raw, typed, checks, keep, hold)
