"""Command line: ``python -m tickloom.cli <step> [--date D | --start-date A --end-date B]``.

Folders and the serving table come from a configuration file::

    [storage]
    raw = s3a://bucket/raw
    lake = s3a://bucket/processed

    [serving]
    url = jdbc:postgresql://host:5432/market
    table = ticks_summary
    user = ...

Without ``[serving]`` no serving table is kept; further entries of it are passed on
as JDBC options. A blank date is today. The exit code is 1 if a day failed to land or a
file could not be read.
"""

from __future__ import annotations

import argparse
import configparser
import datetime as dt
import sys

from pyspark.sql import SparkSession, functions as F

from tickloom.operators.runs import requested_days
from tickloom.plans import backfill as ranges
from tickloom.plans.daily import Lake, run_cancel_load, run_tick_load
from tickloom.schemas import FAILED
from tickloom.session import cluster_session

# Default range of a backfill.
BACKFILL_FROM, BACKFILL_TO = "2026-03-01", "2026-04-30"


def _day(text: str) -> dt.date | None:
    return dt.date.fromisoformat(text.strip()) if text.strip() else None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickloom", description="Daily tick analytics")
    steps = top.add_subparsers(dest="step", required=True)
    for name, text in {
        "land": "log the state of the raw files of the requested days",
        "ticks": "load ticks and their summary",
        "cancels": "load trade cancellations",
        "backfill": "load both for a range of days",
        "reload": "fill the serving table from the whole summary",
        "maintain": "compact the detail tables",
    }.items():
        step = steps.add_parser(name, help=text)
        step.add_argument("--config", default="tickloom.ini")
        if name in ("land", "ticks", "cancels"):
            step.add_argument("--date", default="")
        if name in ("ticks", "cancels", "backfill"):
            step.add_argument("--csv", action="store_true", help="write the tables as text too")
        if name in ("land", "ticks", "cancels", "backfill"):
            in_range = name == "backfill"
            step.add_argument("--start-date", default=BACKFILL_FROM if in_range else "")
            step.add_argument("--end-date", default=BACKFILL_TO if in_range else "")
        if name == "maintain":
            step.add_argument("--delete-expired", action="store_true")
        if name == "backfill":
            step.add_argument("--skip-ingestion", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    config = configparser.ConfigParser(interpolation=None)
    if not config.read(args.config):
        sys.exit(f"no configuration file at {args.config}")
    raw, lake = config["storage"]["raw"].strip(), Lake(config["storage"]["lake"].strip())
    if spark is None:
        spark = cluster_session(f"tickloom-{args.step}")

    if args.step == "reload":
        ranges.reload_serving(spark, lake, **dict(config["serving"]))
        return 0
    if args.step == "maintain":
        for path, dates in ranges.maintain(spark, lake).items():
            print(f"{path}: {len(dates)} dates compacted")
        if args.delete_expired:
            print(f"{ranges.drop_expired(spark, dt.datetime.now()).count()} expired files")
        return 0

    days = requested_days(
        spark, _day(getattr(args, "date", "")), _day(args.start_date), _day(args.end_date)
    )
    if args.step == "land":
        landed = ranges.record_landing(spark, raw, lake, days).join(
            days.selectExpr("cast(job_date AS string) AS job_date"), "job_date", "left_semi"
        )
        landed.show(truncate=False)
        return int(not landed.where(F.col("status") == FAILED).isEmpty())
    failed = False
    if args.step == "backfill":
        result = ranges.backfill(spark, raw, lake, days, args.skip_ingestion, args.csv)
        result.report.show(truncate=False)
        failed = not result.report.where(F.col("status") == FAILED).isEmpty()
        loads = {"ticks": result.ticks, "cancels": result.cancels}
    else:
        run = run_tick_load if args.step == "ticks" else run_cancel_load
        loads = {args.step: run(spark, raw, lake, days, args.csv)}
    if "ticks" in loads and loads["ticks"].dates and config.has_section("serving"):
        ranges.update_serving(spark, lake, loads["ticks"].dates, **dict(config["serving"]))
    for name, done in loads.items():
        print(f"{name}: {done.rows} rows on {len(done.dates)} dates, {done.rejected} rejected")
        if done.file_errors is not None and (count := done.file_errors.count()):
            failed = True
            print(f"{name}: {count} files skipped, among them:", file=sys.stderr)
            for row in done.file_errors.orderBy("path").limit(20).collect():
                print(f"{name}: {row.path}: {row.error}", file=sys.stderr)
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
