"""Command line in-process: load twice (second adds nothing), report, check."""

import contextlib
import glob
import io
import json
import shutil

import pytest

from sparkmart.__main__ import main
from sparkmart.plans.inputs import CSV_FILES
from sparkmart.sources import csv as csv_src
from sparkmart.sources import testdata
from tests import fixtures as fx


@pytest.mark.parametrize("single", [True, False])
def test_cli_load_report_check(spark, scratch, single):
    inbox, wh = f"{scratch}/in", f"{scratch}/wh"
    cust = fx.customers(spark, [fx.cust_row(1), fx.cust_row(2)])
    prod = fx.products(spark, [fx.prod_row("P1", 2.5, 0)])
    tx = fx.transactions(spark, [(1, 1, "P1", 2, fx.d("2016-04-02"), 0), (2, 2, "P1", 1, fx.d("2016-05-02"), 1)])
    csv_src.write_csv(testdata.customers_as_csv(cust).coalesce(1), f"{inbox}/{CSV_FILES['customers']}")
    csv_src.write_csv(testdata.products_as_csv(prod).coalesce(1), f"{inbox}/{CSV_FILES['products']}")
    csv_src.write_csv(testdata.transactions_as_csv(tx).coalesce(1), f"{inbox}/{CSV_FILES['transactions']}")
    if single:                                  # files named like the inputs, not folders
        for name in CSV_FILES.values():
            part, = glob.glob(f"{inbox}/{name}/part-*")
            shutil.copy(part, f"{inbox}/{name}.csv")
            shutil.rmtree(f"{inbox}/{name}")
    outputs = []
    for _ in range(2):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            main(["load", "--input", inbox, "--warehouse", wh, "--calendar", "2016-01-01", "2016-12-31"])
        outputs.append(json.loads(buf.getvalue().strip().splitlines()[-1])["rows_added"])
    assert outputs[0]["fact_sales"] == 2 and set(outputs[1].values()) == {0}
    main(["report", "q12", "--warehouse", wh, "--set", "year=2016", "--output", f"{scratch}/q12"])
    rows = spark.read.option("header", True).csv(f"{scratch}/q12").collect()
    assert sorted((r.quarter, r.total_sales) for r in rows) == [("2", "7.50")]
    main(["sql", "SELECT count(*) AS n FROM fact_sales", "--warehouse", wh, "--output", f"{scratch}/n"])
    assert spark.read.option("header", True).csv(f"{scratch}/n").first().n == "2"
    assert spark.range(3).count() == 3  # the caller's session is still running


def test_a_callers_session_keeps_its_settings(spark):
    from sparkmart.session import build_session
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert build_session(app="other") is spark
        assert spark.conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
