"""Compare every registered query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Rows are compared as multisets (order-insensitive) after sorting columns by
name; values are compared exactly (decimals as Decimal, floats bit for bit).
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", v.normalize() if v == v else "nan")
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", v)
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat())
    return ("v", v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(cols[i] for i in order),
            sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)]


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sql = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as ex:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(ex).__name__}: {str(ex)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = f"rows-only {len(srows)}"
            print(f"{name:40s} {results[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(ex)[:300]}"
            print(name, results[name], flush=True)
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a[0] != b[0]:
            results[name] = f"COLUMNS spark={a[0]} duck={b[0]}"
        elif len(a[1]) != len(b[1]):
            results[name] = f"ROWCOUNT spark={len(a[1])} duck={len(b[1])}"
        elif a[1] != b[1]:
            diff = [(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]
            results[name] = f"VALUES differ e.g. {diff}"
        else:
            results[name] = f"ok {len(a[1])} rows"
        print(f"{name:40s} {results[name]} ({ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from sparkmart.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(conf={"spark.ui.showConsoleProgress": "false"})
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
