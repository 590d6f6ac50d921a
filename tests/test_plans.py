"""Plan shape of the reports over a stored star: no cartesian or nested-loop
joins, year filters reach the fact scan as partition filters, and the fact
scan reads only the columns a report needs."""

import contextlib
import io
import re

from sparkmart.plans import olap
from sparkmart.plans.etl import star_rows
from sparkmart.sources.warehouse import read_star, write_star
from tests import fixtures as fx

YEAR_FILTERED = {"q01_top_products_daytype_month", "q04_gender_age_quarterly",
                 "q06_city_marital_monthly", "q09_monthly_growth_by_category",
                 "q10_daytype_by_age", "q11_top_products_drilldown", "q12_store_quarterly_growth"}
FACT_COLUMNS = {"order_id", "customer_id", "product_id", "date_id", "store_id", "supplier_id",
                "quantity", "revenue"}


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_report_plans(spark, scratch):
    tx = [(i, 1 + i % 2, f"P{i % 3}", 1 + i % 4, fx.d(f"2016-0{1 + i % 9}-1{i % 10}"), i) for i in range(40)]
    prods = [fx.prod_row(f"P{i}", 1.5 + i, i, store=1 + i % 2, sup=1 + i % 3) for i in range(3)]
    star = star_rows(spark, fx.inputs(spark, [fx.cust_row(1), fx.cust_row(2)], prods, tx))
    write_star(star, f"{scratch}/wh")
    stored = read_star(spark, f"{scratch}/wh")
    params = {"year": 2016}
    for name, (fn, key) in olap.REPORTS.items():
        kwargs = {"anchor": "2016-04-12"} if key == "q06" else (
            {"store_name": "S1"} if key == "q20" else (params if key else {}))
        plan = _plan(fn(stored, **kwargs))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name == "q16_product_affinity":      # reads its stored collapse; every pair join is by basket
            assert "customer_id" in plan and not re.search(r"Join.*\n.*keys \[1\]: \[product_a", plan)
            continue
        fact_scans = [m for m in re.findall(r"ReadSchema: struct<(.*?)>", plan) if "revenue" in m
                      or "customer_id:bigint,date_id" in m or "customer_id:bigint,product_id" in m]
        assert fact_scans, name
        for cols in fact_scans:
            read = set(re.findall(r"(?:^|,)(\w+):", cols))
            assert read <= FACT_COLUMNS and len(read) <= 5, (name, read)
        if name in YEAR_FILTERED:
            assert re.search(r"PartitionFilters: \[[^\]]*sale_year", plan), name


def test_affinity_deals_no_baskets_by_product_if_no_bound_drops_any(spark):
    """Every product sells oftener than the k-th pair: the pairs are all counted, without a join by product."""
    from collections import Counter
    from itertools import combinations

    from sparkmart.operators.affinity import top_pairs
    baskets = [[(i + j * s) % 13 for j in range(4)] for i in range(13) for s in range(1, 7)]
    rows = [(n, 20160101, f"P{p:02d}") for n, items in enumerate(baskets) for p in items]
    want = Counter()
    for items in baskets:
        c = Counter(f"P{p:02d}" for p in items)
        want.update({(a, b): c[a] * c[b] for a, b in combinations(sorted(c), 2)})
    best = sorted((-n, *pair) for pair, n in want.items())[:5]
    assert min(Counter(r[2] for r in rows).values()) > -best[-1][0] >= 2
    pairs = top_pairs(spark.createDataFrame(rows, "customer_id long, date_id int, product_id string"))
    assert [(-r.together_count, r.product_a, r.product_b) for r in pairs.collect()] == best
    assert not re.search(r"keys \[1\]: \[product_id|hashpartitioning\(product_id", _plan(pairs))
