"""Date-range loads, reload of the serving table, landing record and upkeep."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.days import calendar_rows, is_weekday
from tickloom.operators import runs
from tickloom.plans.daily import Lake, Loaded, run_cancel_load, run_tick_load
from tickloom.schemas import FAILED, RUN_LOG, RUNNING, SKIPPED, SUCCESS, SUMMARY
from tickloom.session import fresh_dir, shared_root
from tickloom.sinks.serving import refresh_serving, replace_serving
from tickloom.sinks.tables import append_runs
from tickloom.sinks.upkeep import RETENTION_HOURS, compact, delete_files, retention_candidates
from tickloom.sources.files import list_files
from tickloom.sources.rawzone import completeness, file_day, landing_manifest, raw_listing
from tickloom.sources.tables import read_dates, read_or_empty, read_table


# Fixed value: what the log says of a skipped day.
HOLIDAY = "Holiday or Weekend"


@dataclass(frozen=True)
class BackfillResult:
    plan: DataFrame
    ticks: Loaded
    cancels: Loaded
    report: DataFrame


def read_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """The run log; empty before its first entry."""
    return read_or_empty(spark, lake.runs, RUN_LOG)


def plan_backfill(
    spark: SparkSession, raw_root: str, lake: Lake, days: DataFrame, skip_ingestion: bool = False
) -> DataFrame:
    """Action per requested day, from the raw zone and the run log."""
    current = runs.latest_runs(read_runs(spark, lake))
    current = current.withColumn("job_date", F.col("job_date").try_cast("date"))
    complete = completeness(raw_listing(spark, raw_root, days))
    return runs.backfill_plan(days, complete, current, skip_ingestion)


def backfill(
    spark: SparkSession, raw_root: str, lake: Lake, days: DataFrame, skip_ingestion: bool = False,
    as_csv: bool = False,
) -> BackfillResult:
    """Load the days of a range that the plan names ``etl``, in one tick and one cancellation pass.

    The plan is fixed before anything is loaded. Each pass is one DataFrame over the files
    of all days, so the range runs in parallel. ``report`` counts and lists the days that
    succeeded, failed, were skipped or are still to be landed.
    """
    plan = plan_backfill(spark, raw_root, lake, days, skip_ingestion)
    plan = spark.createDataFrame(calendar_rows(plan), plan.schema)
    ready = plan.where("action = 'etl'").select("job_date")
    ticks = run_tick_load(spark, raw_root, lake, ready, as_csv)
    cancels = run_cancel_load(spark, raw_root, lake, ready, as_csv)
    failed = spark.createDataFrame([], "job_date date")
    if ticks.file_errors is not None:
        failed = ticks.file_errors.select(file_day(F.col("path")).alias("job_date")).distinct()
    status = (
        F.when(F.col("bad"), FAILED).when(F.col("action") == "etl", SUCCESS)
        .when(F.col("action") == "skip", SKIPPED).otherwise(F.col("action"))
    )
    outcome = plan.join(failed.withColumn("bad", F.lit(True)), "job_date", "left").select(
        F.col("job_date").cast("string"), status.alias("status")
    )
    return BackfillResult(plan, ticks, cancels, runs.outcome_report(outcome))


def record_landing(
    spark: SparkSession, raw_root: str, lake: Lake, days: DataFrame, probes: DataFrame | None = None
) -> DataFrame:
    """Log one run per requested day from the files found in the raw zone.

    A ``running`` entry comes first, the outcome when the files have been looked at. A day
    with its two data files succeeded, whether or not the structure files came along. A
    day without any file is a holiday if it is a weekend, or if the feed's lookups
    (``probes``) say so; otherwise its files are missing and it failed.
    """
    keyed = days.select(F.date_format("job_date", "yyyy-MM-dd").alias("job_date"))
    started = dt.datetime.now(dt.timezone.utc)
    empty = F.lit(None).cast("string")
    append_runs(
        keyed.select(
            "job_date", F.lit(RUNNING).alias("status"), F.lit(started).alias("started_at"),
            empty.alias("ended_at"), empty.alias("results"),
        ),
        lake.runs,
    )
    listing = raw_listing(spark, raw_root, days)
    files = landing_manifest(days, listing)
    per_file = F.struct("filename", "status", "error", "info")
    per_day = files.groupBy("job_date").agg(
        F.sort_array(F.collect_list(per_file)).alias("files"),  # four entries per day
        F.max(F.col("status") == SUCCESS).alias("any_file"),
    )
    holiday = ~is_weekday(F.col("job_date"))
    if probes is not None:
        found = runs.resolve_feed_ids(days, probes).select("job_date", "origin")
        per_day = per_day.join(found, "job_date", "left")
        holiday = holiday | F.coalesce(F.col("origin") == "holiday", F.lit(False))
    skipped = ~F.col("any_file") & holiday
    status = F.when(skipped, SKIPPED).when(F.coalesce("complete", F.lit(False)), SUCCESS).otherwise(FAILED)
    entries = per_day.join(completeness(listing), "job_date", "left").select(
        F.date_format("job_date", "yyyy-MM-dd").alias("job_date"),
        status.alias("status"),
        F.lit(started).alias("started_at"),
        F.current_timestamp().alias("ended_at"),
        F.when(skipped, HOLIDAY).otherwise(F.to_json("files")).alias("results"),
    )
    append_runs(entries, lake.runs)
    return runs.latest_runs(read_runs(spark, lake))


def reload_serving(spark: SparkSession, lake: Lake, url: str, table: str, **options: str) -> None:
    """Fill the serving table from the whole summary in the lake."""
    refresh_serving(read_table(spark, lake.summary), url, table, **options)


def maintain(spark: SparkSession, lake: Lake) -> dict[str, list[dt.date]]:
    """Compact both detail tables; returns the rewritten dates of each."""
    return {path: compact(spark, path) for path in (lake.ticks, lake.cancels)}


def drop_expired(spark: SparkSession, now: dt.datetime, hours: int = RETENTION_HOURS) -> DataFrame:
    """Delete this package's intermediates older than the retention.

    Only files below its own folder of the shared root are looked at; nothing there
    is live once its run has ended. Returns one row per file with its outcome.
    """
    listing = list_files(spark, f"{shared_root(spark)}/tickloom")
    outcome = fresh_dir(spark, "expired")
    old = retention_candidates(listing, spark.createDataFrame([], "path string"), now, hours)
    delete_files(old).write.parquet(outcome)  # once, whatever is done with the report
    return spark.read.parquet(outcome)


def update_serving(
    spark: SparkSession, lake: Lake, dates: list[dt.date], url: str, table: str, **options: str
) -> None:
    """Bring the summary of some dates to the serving table; a repeat changes nothing."""
    summary = read_dates(spark, lake.summary, dates, SUMMARY)
    replace_serving(summary, url, table, **options)
