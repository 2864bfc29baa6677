"""Runs a job: ``python -m fleetlake --lake URI {ingest,summary,backfill,compact,views} ...``"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from fleetlake.plans import ingest, summary
from fleetlake.registry import Lake
from fleetlake.sources.tables import catalog_listing, create_views


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fleetlake")
    parser.add_argument("--lake", required=True, help="base URI of the lake")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("ingest", help="load new files")
    load.add_argument("incoming", help="folder of envelope files")
    load.add_argument("--policy", choices=[ingest.FAIL_BATCH, ingest.QUARANTINE], default=ingest.FAIL_BATCH)
    load.add_argument("--retry-failed", action="store_true")
    load.add_argument("--recursive", action="store_true")
    load.add_argument("--incremental", action="store_true", help="list what is newer than the last run, less a day")
    load.add_argument("--dated", help="date format of the folders that files are delivered to, such as %%Y-%%m-%%d")
    daily = jobs.add_parser("summary", help="summarise the day before a date")
    daily.add_argument("target_date", nargs="?", help="YYYY-MM-DD, today in UTC if left out")
    past = jobs.add_parser("backfill", help="recompute a range of days")
    past.add_argument("--start-date", type=date.fromisoformat, required=True)
    past.add_argument("--end-date", type=date.fromisoformat, required=True)
    past.add_argument("--lookback-days", type=int, help="only arrivals within so many days")
    past.add_argument("--replace-all", action="store_true", help="also days whose raw events are not there")
    fold = jobs.add_parser("compact", help="fold summary changes in")
    fold.add_argument("--before", type=date.fromisoformat, help="only days before this one")
    jobs.add_parser("views", help="create the databases and views")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = Lake(args.lake)
    if args.job == "ingest":
        ingest.run_ingest(
            spark,
            lake,
            args.incoming,
            policy=args.policy,
            retry_failed=args.retry_failed,
            recursive=args.recursive,
            incremental=args.incremental,
            dated=args.dated,
        ).show(truncate=False)
    elif args.job == "summary":
        print(summary.run_daily_summary(spark, lake, summary.target(args.target_date)))
    elif args.job == "backfill":
        result = summary.run_backfill(
            spark, lake, args.start_date, args.end_date, args.lookback_days, replace_all=args.replace_all
        )
        print(result)
    elif args.job == "compact":
        print(summary.compact_summary(spark, lake.summary, args.before))
    else:
        create_views(spark, lake)
        catalog_listing(spark).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    run(SparkSession.builder.appName("fleetlake").getOrCreate(), args)


if __name__ == "__main__":
    main()
