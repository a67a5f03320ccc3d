"""Run the daily job or a back-fill, e.g. with ``spark-submit -m`` or from a scheduler.

    python -m finlake run-day s3a://lake 2025-04-15
    python -m finlake backfill s3a://lake 2025-04-15 2025-05-15
    python -m finlake ingest s3a://lake sales 2025-04-15
    python -m finlake refresh s3a://lake products 2025-04-15 2025-04-17
    python -m finlake compact s3a://lake freight
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import SparkSession

from finlake import REPORTS, SPECS, Lake, backfill, compact, ingest, refresh_gold, run_day


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="finlake", description=__doc__.splitlines()[0])
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run-day", help="ingest every source for a day, refresh reports")
    one.add_argument("lake")
    one.add_argument("day", type=date.fromisoformat)
    one.add_argument("--changed-days", action="store_true", help="refresh every day whose rows changed")
    many = commands.add_parser("backfill", help="process every day from one to another, inclusive")
    many.add_argument("lake")
    many.add_argument("first", type=date.fromisoformat)
    many.add_argument("last", type=date.fromisoformat)
    many.add_argument("--replay", action="store_true", help="one day after the other")
    source = commands.add_parser("ingest", help="bring one source's file of a day into its table")
    source.add_argument("lake")
    source.add_argument("source", choices=sorted(SPECS))
    source.add_argument("day", type=date.fromisoformat)
    report = commands.add_parser("refresh", help="recompute days of one summary table")
    report.add_argument("lake")
    report.add_argument("report", choices=sorted(REPORTS))
    report.add_argument("days", type=date.fromisoformat, nargs="+")
    packed = commands.add_parser("compact", help="pack the small files of a source's table")
    packed.add_argument("lake")
    packed.add_argument("source", choices=sorted(SPECS))
    packed.add_argument("days", type=date.fromisoformat, nargs="*", help="all days if there is none")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("finlake").getOrCreate()
    lake = Lake.at(args.lake, args.format)
    if args.command == "run-day":
        run_day(spark, lake, args.day, changed_days=args.changed_days)
    elif args.command == "ingest":
        ingest(spark, lake, SPECS[args.source], args.day)
    elif args.command == "refresh":
        refresh_gold(spark, lake, args.report, args.days)
    elif args.command == "compact":
        compact(spark, lake, SPECS[args.source], args.days or None)
    else:
        days = [args.first + timedelta(n) for n in range((args.last - args.first).days + 1)]
        backfill(spark, lake, days, replay=args.replay)


if __name__ == "__main__":
    main()
