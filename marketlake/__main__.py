"""Command line for spark-submit: one sub-command per job.

    spark-submit run_job.py reference-load --landing L --ref R --run-date 2025-05-01
    spark-submit run_job.py daily-load --landing L --ref R --warehouse W --run-date 2025-07-10
    spark-submit run_job.py backfill --landing L --ref R --warehouse W --start D1 --end D2
    spark-submit run_job.py quality --warehouse W --out O
    spark-submit run_job.py export --warehouse W --out O --format csv

(ship the package with ``--py-files``; ``python -m marketlake …`` locally).
Master, executors and ``spark.checkpoint.dir`` come from spark-submit /
spark-defaults.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from . import schemas
from .plans import jobs
from .session import build_session
from .sinks.writers import export_tables
from .sources.tables import filter_time_id, read_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marketlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("reference-load", help="monthly reference load (LOD-1)")
    r.add_argument("--landing", required=True)
    r.add_argument("--ref", required=True)
    r.add_argument("--run-date", required=True)
    r.add_argument("--run-ts", default=None, help="default: run date at 00:00:00")
    r.add_argument("--hash-mode", default="json", choices=["json", "concat"])

    d = sub.add_parser("daily-load", help="daily warehouse load of one run date")
    for name in ("--landing", "--ref", "--warehouse", "--run-date"):
        d.add_argument(name, required=True)
    d.add_argument("--extract-as-of", default=None, help="only companies changed on this day")
    d.add_argument("--news-cap", type=int, default=None, help="news are raw responses of at most this many articles")
    d.add_argument("--split-hot", action="store_true", help="keep hot tickers out of the joins' shuffles")

    b = sub.add_parser("backfill", help="warehouse load of a run-date range (BKF-1)")
    for name in ("--landing", "--ref", "--warehouse", "--start", "--end"):
        b.add_argument(name, required=True)
    b.add_argument("--news-cap", type=int, default=None, help="news are raw responses of at most this many articles")
    b.add_argument("--split-hot", action="store_true", help="keep hot tickers out of the joins' shuffles")
    b.add_argument("--chunk-days", type=int, default=None, help="days per commit; a broken run goes on behind its last commit")

    q = sub.add_parser("quality", help="data-quality report over the warehouse")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--days", default=None, help="only the partitions of these days (yyyymmdd, comma-separated)")

    e = sub.add_parser("export", help="export warehouse tables with a manifest")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--format", default="json", choices=["json", "csv", "parquet"])
    e.add_argument("--tables", default=",".join(schemas.WAREHOUSE_TABLES))
    e.add_argument("--time-id", default=None, help="only this day, for tables that have a time_id")
    return p


def main(argv=None, spark=None) -> int:
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or build_session(app_name=f"marketlake-{args.cmd}")
    if args.cmd == "reference-load":
        dt.date.fromisoformat(args.run_date)
        run_ts = args.run_ts or f"{args.run_date} 00:00:00"
        quarantine, report = jobs.run_reference_load(spark, args.landing, args.ref,
                                                     args.run_date, run_ts, args.hash_mode)
        report.show(truncate=False)
        print(json.dumps({"quarantined": quarantine.count()}))
    elif args.cmd == "daily-load":
        print(json.dumps(jobs.run_daily_load(spark, args.landing, args.ref, args.warehouse,
                                             args.run_date, extract_as_of=args.extract_as_of,
                                             news_cap=args.news_cap, split_hot=args.split_hot)))
    elif args.cmd == "backfill":
        print(json.dumps(jobs.run_backfill(spark, args.landing, args.ref, args.warehouse,
                                           args.start, args.end, news_cap=args.news_cap,
                                           chunk_days=args.chunk_days, split_hot=args.split_hot)))
    elif args.cmd == "quality":
        wh = {n: read_table(spark, args.warehouse, n) for n in schemas.WAREHOUSE_TABLES}
        days = [int(d) for d in args.days.split(",")] if args.days else None
        jobs.warehouse_quality(wh, days).coalesce(1).write.mode("overwrite").json(args.out)
    elif args.cmd == "export":
        names = [n for n in args.tables.split(",") if n]
        tables = {n: read_table(spark, args.warehouse, n) for n in names}
        if args.time_id:
            tables = {n: filter_time_id(t, args.time_id) if "time_id" in t.columns else t for n, t in tables.items()}
        export_tables(spark, tables, args.out, args.format).show(truncate=False)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
