"""Batch front ends: inputs -> cleaned, typed rows for the ETL core.

Two front ends feed the same ETL core (``plans.etl``):

* ``testdata_inputs``: typed inputs derived from the parquet test tables;
* ``csv_inputs``: the reference's three CSV files (all text), cleaned with
  quarantine outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators.clean import clean_customers, clean_products, clean_transactions
from sparkmart.plans.etl import Inputs
from sparkmart.sources import csv as csv_src
from sparkmart.sources import testdata
from sparkmart.sources.calendar import DEFAULT_END, DEFAULT_START

#: Input names; each is a file ``<name>.csv`` or a folder of this name.
CSV_FILES = {
    "customers": "customer_master_data",
    "products": "product_master_data",
    "transactions": "transactional_data",
}


def testdata_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        customers=testdata.customers(spark, sf_dir),
        products=testdata.products(spark, sf_dir),
        transactions=testdata.transactions(spark, sf_dir),
        calendar=testdata.calendar_range(spark, sf_dir),
    )


@dataclass
class CleanedCsv:
    inputs: Inputs
    rejects: dict[str, DataFrame]


def csv_inputs(spark: SparkSession, folder: str,
               calendar: tuple[str, str] = (DEFAULT_START, DEFAULT_END)) -> CleanedCsv:
    """Read and clean the three CSV inputs found under ``folder``."""
    cust, cust_bad = clean_customers(csv_src.read_customer_master(spark, csv_path(spark, folder, "customers")))
    prod, prod_bad = clean_products(csv_src.read_product_master(spark, csv_path(spark, folder, "products")))
    tx, tx_bad = clean_transactions(csv_src.read_transactions_batch(spark, csv_path(spark, folder, "transactions")))
    return CleanedCsv(Inputs(cust, prod, tx, calendar),
                      {"customers": cust_bad, "products": prod_bad, "transactions": tx_bad})


def csv_path(spark: SparkSession, folder: str, which: str) -> str:
    """Path of an input: ``<name>.csv`` if it is there, else the folder ``<name>``."""
    from sparkmart.sources.warehouse import path_exists
    base = f"{folder.rstrip('/')}/{CSV_FILES[which]}"
    return f"{base}.csv" if path_exists(spark, f"{base}.csv") else base


def export_testdata_csv(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the test-table inputs as the reference's three CSV files.

    All transactions of an order are written to one file, sorted by (order,
    product, source position), so file order reproduces the source position on
    re-read.  They come dealt by order from the join that derives them, so this
    needs no range sort, which would run that join once more for its sample.
    """
    base = folder.rstrip("/")
    inp = testdata_inputs(spark, sf_dir)
    csv_src.write_csv(testdata.customers_as_csv(inp.customers.orderBy("customer_id")),
                      f"{base}/{CSV_FILES['customers']}")
    csv_src.write_csv(testdata.products_as_csv(inp.products.orderBy("product_id")),
                      f"{base}/{CSV_FILES['products']}")
    csv_src.write_csv(testdata.transactions_as_csv(by_order(inp.transactions)), f"{base}/{CSV_FILES['transactions']}")


def by_order(transactions: DataFrame) -> DataFrame:
    """Each order in one partition, its transactions in source order per product."""
    return transactions.repartition("order_id").sortWithinPartitions("order_id", "product_id", "src_pos")
