"""Command line: ``python -m sparkmart <command> ...``

  load    --input DIR --warehouse DIR [--calendar START END]
          read the three CSV inputs, clean, load (idempotent), keep rejects
  report  NAME --warehouse DIR [--set key=value ...] [--output PATH]
          run one of the twenty reports
  sql     STATEMENT --warehouse DIR [--output PATH]
          run a statement over the warehouse's tables
  check   --warehouse DIR
          row counts, primary-key and foreign-key checks
  stream  --inbox DIR --warehouse DIR --checkpoint DIR [--ttl "24 hours"]
          [--once] [--fmt csv|parquet] [--calendar START END]
          streaming load with the waiting TTL for late customers
"""

from __future__ import annotations

import argparse
import json

from sparkmart.sources.calendar import DEFAULT_END, DEFAULT_START


def _value(text: str):
    for cast in (int, float):
        try:
            return cast(text)
        except ValueError:
            pass
    return text


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="sparkmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--input", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--calendar", nargs=2, default=[DEFAULT_START, DEFAULT_END])
    p = sub.add_parser("report")
    p.add_argument("name")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--output")
    p = sub.add_parser("sql")
    p.add_argument("statement")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--output")
    p = sub.add_parser("check")
    p.add_argument("--warehouse", required=True)
    p = sub.add_parser("stream")
    p.add_argument("--inbox", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--ttl", default="24 hours")
    p.add_argument("--once", action="store_true", help="process what is there, then stop")
    p.add_argument("--fmt", default="csv", choices=["csv", "parquet"])
    p.add_argument("--calendar", nargs=2, default=[DEFAULT_START, DEFAULT_END])
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from sparkmart.session import build_session
    owned = SparkSession.getActiveSession() is None  # stop only a session we start
    spark = build_session(app=f"sparkmart-{args.cmd}")

    if args.cmd == "load":
        from sparkmart.plans.etl import load_warehouse
        from sparkmart.plans.inputs import csv_inputs
        cleaned = csv_inputs(spark, args.input, calendar=tuple(args.calendar))
        added = load_warehouse(spark, cleaned.inputs, args.warehouse, quarantine=cleaned.rejects)
        print(json.dumps({"rows_added": added}))
    elif args.cmd in ("report", "sql"):
        from sparkmart.plans import olap
        from sparkmart.sources.warehouse import read_star
        star = read_star(spark, args.warehouse)
        if args.cmd == "sql":
            olap.register_views(spark, star)
            df = spark.sql(args.statement)
        else:
            params = dict(kv.split("=", 1) for kv in args.set)
            name = next(n for n in olap.REPORTS if n == args.name or n.startswith(args.name + "_"))
            df = olap.REPORTS[name][0](star, **{k: _value(v) for k, v in params.items()})
        if args.output:
            df.write.mode("overwrite").option("header", True).csv(args.output)
        else:
            df.show(50, truncate=False)
    elif args.cmd == "check":
        from sparkmart.operators import quality
        from sparkmart.sources.warehouse import read_star
        star = read_star(spark, args.warehouse)
        quality.row_count_audit(star.tables()).show()
        quality.pk_violations(star.tables()).show()
        quality.fk_violations(star.fact_sales, star.tables()).show()
    elif args.cmd == "stream":
        from sparkmart.sources.calendar import dim_date
        from sparkmart.streaming.hybrid_join import ensure_dim_date
        from sparkmart.streaming.jobs import start_hybrid_load
        ensure_dim_date(spark, args.warehouse, dim_date(spark, *args.calendar))
        q = start_hybrid_load(spark, args.inbox, args.warehouse, args.checkpoint, ttl=args.ttl,
                              available_now=args.once, processing_time=None if args.once else "10 seconds",
                              fmt=args.fmt)
        q.awaitTermination()
    if owned:
        spark.stop()


if __name__ == "__main__":
    main()
