"""A customer holding a third of all sales: results stay exact and the plans
aggregate by customer before the customer join."""

import contextlib
import io
import random
from collections import defaultdict
from decimal import Decimal

from sparkmart.plans import olap
from sparkmart.plans.etl import star_rows
from tests import fixtures as fx


def _skewed_star(spark):
    rnd = random.Random(11)
    custs = [fx.cust_row(i, gender="MF"[i % 2], age=f"a{i % 3}", city="ABC"[i % 3]) for i in range(1, 21)]
    prods = [fx.prod_row(f"P{i}", 1.0 + i, i, store=1 + i % 2, sup=1 + i % 3) for i in range(6)]
    tx = []
    for n in range(900):
        cust = 1 if n % 3 == 0 else rnd.randint(2, 20)
        tx.append((n, cust, f"P{rnd.randint(0, 5)}", rnd.randint(1, 4),
                   fx.d(f"2016-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}"), n))
    return star_rows(spark, fx.inputs(spark, custs, prods, tx)), custs, prods, tx


def test_hot_customer_report_is_exact(spark):
    star, custs, prods, tx = _skewed_star(spark)
    price = {p[0]: Decimal(str(p[2])) for p in prods}
    attrs = {c[0]: (c[4], c[1], c[2]) for c in custs}
    want = defaultdict(Decimal)
    for _, cust, pid, qty, _, _ in tx:
        want[attrs[cust]] += (price[pid] * qty).quantize(Decimal("0.01"))
    got = {(r.city_category, r.gender, r.age): r.total_purchase_amount
           for r in olap.q02_demographics_by_city(star).collect()}
    assert got == dict(want)


def test_customer_join_sees_aggregated_rows(spark):
    star, *_ = _skewed_star(spark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        olap.q02_demographics_by_city(star).explain()
    plan = buf.getvalue()
    # partial aggregate keyed by customer_id exists below the join
    join_at = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin")) if i >= 0)
    assert "keys=[customer_id" in plan[join_at:] and "partial_sum" in plan[join_at:]
