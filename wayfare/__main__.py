"""Command line for spark-submit.

    spark-submit --py-files wayfare.zip -m wayfare run-month --raw R --processed P --period 2016-01
    python -m wayfare backfill --raw R --processed P --start 2016-01 --end 2016-04
    python -m wayfare ingest --raw R --processed P [--every "10 minutes"]
    python -m wayfare check --raw R --processed P --start 2016-01 [--end 2016-04]
    python -m wayfare publish --raw R --processed P --start 2016-01 [--end 2016-04] [--keep-rejects]
    python -m wayfare reconcile --raw R --processed P --start 2016-01 [--end 2016-04]
    python -m wayfare retire --raw R --processed P [--keep 2]

``publish`` writes the months aside, checks them and makes them visible together;
``reconcile`` needs months loaded with ``--keep-rejects``; ``retire`` removes
manifests but the newest and the files that none of them names.

The master and cluster settings come from spark-submit; only the settings the
jobs need are added to the session (see ``session.RECOMMENDED_CONF``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import Layout, Options
from .periods import month_range
from .plans import pipeline
from .session import RECOMMENDED_CONF, ensure_checkpoint_dir
from .sinks import published


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wayfare")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run-month", "backfill", "ingest", "check", "publish", "reconcile", "retire"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True, help="raw landing zone root")
        s.add_argument("--processed", required=True, help="processed tables root")
        s.add_argument("--mode-label", default="Air")
        s.add_argument("--append", action="store_true", help="plain appends (not idempotent)")
        s.add_argument("--lenient-ports", action="store_true")
        s.add_argument("--distinct-city", action="store_true")
        s.add_argument("--coord-order", default="lat_lon", choices=["lat_lon", "lon_lat"])
        s.add_argument("--arrivals-format", default="parquet", choices=["parquet", "csv"])
        s.add_argument("--skip-reference", action="store_true",
                       help="do not rebuild code tables and dimensions")
        s.add_argument("--keep-rejects", action="store_true", help="store dropped records and their audit")
        if name == "run-month":
            s.add_argument("--period", required=True, help="yyyy-MM")
        if name in ("backfill", "check", "publish", "reconcile"):
            s.add_argument("--start", required=True)
            s.add_argument("--end")
        if name == "retire":
            s.add_argument("--keep", type=int, default=2, help="manifests that stay")
        if name == "ingest":
            s.add_argument("--every", help="processing-time trigger; default: available now")
            s.add_argument("--checkpoint")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"wayfare-{args.command}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    layout = Layout(raw_root=args.raw, processed_root=args.processed,
                    arrivals_format=args.arrivals_format,
                    arrivals_template="arrivals/i94_{token}_sub." + args.arrivals_format)
    options = Options(mode_label=args.mode_label, write_mode="append" if args.append else "dynamic",
                      lenient_ports=args.lenient_ports, distinct_city=args.distinct_city,
                      coord_order=args.coord_order, keep_rejects=args.keep_rejects)
    refresh = not args.skip_reference
    if args.command == "run-month":
        checks = pipeline.run_month(spark, layout, args.period, options, refresh_reference=refresh)
    elif args.command == "backfill":
        checks = pipeline.backfill(spark, layout, args.start, args.end or args.start, options,
                                   refresh_reference=refresh)
    elif args.command == "publish":
        made = pipeline.publish_months(spark, layout, args.start, args.end or args.start, options, refresh_reference=refresh)
        print(f"published\t{made.version}")
        return 0
    elif args.command == "reconcile":
        found = pipeline.reconcile_periods(spark, layout, month_range(args.start, args.end or args.start))
        for row in found.orderBy("i94dt").collect():
            print(f"{row['i94dt']}\t{row['read']}\t{row['kept']}\t{row['rejected']}")
        return 0
    elif args.command == "retire":
        for name in published.retire(spark, layout.published_root(), args.keep):
            print(f"removed\t{name}")
        return 0
    elif args.command == "check":
        checks = pipeline.check_periods(spark, layout, month_range(args.start, args.end or args.start))
    else:
        from .streaming import start_arrivals_ingest
        if refresh:
            pipeline.build_code_tables(spark, layout, options)
        q = start_arrivals_ingest(spark, layout, options, checkpoint=args.checkpoint,
                                  available_now=not args.every, processing_time=args.every)
        q.awaitTermination()
        return 0
    for row in checks.orderBy("table", "i94dt").collect():
        print(f"{row['table']}\t{row['i94dt']}\t{row['rows']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
