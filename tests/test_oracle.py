"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import os

import pytest

from sparkmart.plans import registry
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    results = compare(spark, SF, list(registry.QUERIES))
    bad = {k: v for k, v in results.items() if not v.startswith("ok")}
    assert not bad, bad


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert set(registry.QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["city_category", "gender", "age", "total_purchase_amount"]
    assert df.count() > 0
