"""Business calendar, landing run log, feed identifiers and backfill planning.

All inputs are small next to the ticks: at most a few rows per calendar day. They
are still plain DataFrame operators, so a log kept for decades needs no other path.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.days import business_days, is_weekday
from tickloom.schemas import FAILED, FILE_RESULTS, SKIPPED, SUCCESS

# A feed identifier known to belong to a day.
FEED_ANCHOR_ID, FEED_ANCHOR_DAY = 6211, dt.date(2026, 5, 29)

# Fixed value: how the day shows in the header of an archive offered by the feed.
FEED_HEADER = r"WEBPXTICK_DT-(\d{8})\.zip"


def weekdays_between(bounds: DataFrame) -> DataFrame:
    """Weekdays of each ``(first, last)`` row, both ends included."""
    # A sequence with its ends the wrong way round is an error, not empty.
    in_order = F.col("first") <= F.col("last")
    days = F.when(in_order, F.sequence("first", "last", F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias("job_date")).where(is_weekday(F.col("job_date")))


def requested_days(
    spark: SparkSession,
    day: dt.date | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Days of a run: the weekdays of a range, or else one day as given.

    A single day passes even on a weekend; without any, it is today.
    """
    if first is not None and last is not None:
        span = {"first": first, "last": last}
        return weekdays_between(spark.sql("SELECT :first AS first, :last AS last", args=span))
    return spark.sql("SELECT :day AS job_date", args={"day": day or dt.date.today()})


def latest_runs(log: DataFrame) -> DataFrame:
    """Current state of each day: its run started last, the finished entry first.

    An aggregate rather than a ranking window: a day with very many entries is
    reduced before the shuffle. Structs compare field by field, nulls lowest.
    """
    entry = F.struct("started_at", "ended_at", "status", "results")
    newest = log.groupBy("job_date").agg(F.max(entry).alias("e"))
    return newest.select("job_date", "e.status", "e.started_at", "e.ended_at", "e.results")


def run_report(log: DataFrame) -> DataFrame:
    """One row per file of each run. Free-text results keep their text, without files."""
    parsed = log.withColumn("files", F.from_json("results", FILE_RESULTS))
    text = F.when(F.col("files").isNull(), F.col("results"))
    return parsed.select("*", text.alias("note"), F.explode_outer("files").alias("f")).select(
        "job_date", F.col("status").alias("run_status"), "started_at",
        "f.filename", "f.status", "f.error", "f.info", "note",
    )


def run_outcome(log: DataFrame) -> DataFrame:
    """``failed`` if any file is not ``success``; runs without a file list keep their state.

    A file status may hold an error text, so anything but ``success`` is a failure.
    """
    files = F.from_json("results", FILE_RESULTS)
    any_failed = F.exists(files, lambda f: ~f["status"].eqNullSafe(F.lit(SUCCESS)))
    outcome = F.when(files.isNull(), F.col("status")).when(any_failed, FAILED).otherwise(SUCCESS)
    return log.withColumn("outcome", outcome)


def outcome_report(current: DataFrame) -> DataFrame:
    """Days per status with their sorted list. One entry per day bounds the lists."""
    days = F.sort_array(F.collect_list("job_date"))
    return current.groupBy("status").agg(
        F.count(F.lit(1)).alias("day_count"), F.concat_ws(",", days).alias("days")
    )


def feed_catalog(probes: DataFrame) -> DataFrame:
    """Feed identifier and the day its header names, for identifiers that exist."""
    day = F.regexp_extract(F.col("content_disposition"), FEED_HEADER, 1)
    return (
        probes.where("error is null and status_code <> 404")
        .select("feed_id", F.try_to_date(day, "yyyyMMdd").alias("job_date"))
        .where("job_date is not null")
        .groupBy("job_date").agg(F.min("feed_id").alias("feed_id"))
    )


def resolve_feed_ids(
    days: DataFrame,
    probes: DataFrame,
    anchor_id: int = FEED_ANCHOR_ID,
    anchor_day: dt.date = FEED_ANCHOR_DAY,
    inclusive: bool = True,
) -> DataFrame:
    """Identifier of each day: found in the catalog, else estimated, else null.

    ``probes`` holds one row per lookup: the day it was made for (``job_date``),
    ``feed_id, status_code, content_disposition, error``. The estimate counts
    business days from the anchor and stands in only for days whose lookups hit a
    connection error; a day looked up without error and not found is a holiday.
    """
    catalog = feed_catalog(probes).withColumnRenamed("feed_id", "found_id")
    outages = probes.groupBy("job_date").agg(
        F.max(F.col("error").isNotNull()).alias("unreachable")
    )
    estimate = F.lit(anchor_id) + business_days(F.lit(anchor_day), F.col("job_date"), inclusive)
    joined = days.join(catalog, "job_date", "left").join(outages, "job_date", "left")
    return joined.select(
        "job_date",
        F.coalesce("found_id", F.when(F.col("unreachable"), estimate)).cast("bigint").alias("feed_id"),
        F.when(F.col("found_id").isNotNull(), "catalog")
        .when(F.col("unreachable"), "estimate").otherwise("holiday").alias("origin"),
    )


def backfill_plan(
    days: DataFrame, complete: DataFrame, current_runs: DataFrame, skip_ingestion: bool = False
) -> DataFrame:
    """What to do for each day: ``etl`` its files, ``land`` them first, or ``skip``.

    ``complete`` comes from the raw zone, ``current_runs`` from the run log with
    ``job_date`` as a date. With ``skip_ingestion`` every day counts as ready.
    """
    state = (
        days.join(complete.select("job_date", "complete"), "job_date", "left")
        .join(current_runs.select("job_date", F.col("status").alias("run_status")), "job_date", "left")
    )
    if skip_ingestion:
        action = F.lit("etl")
    else:
        action = (
            F.when(F.coalesce("complete", F.lit(False)), "etl")
            .when(F.col("run_status") == SKIPPED, "skip").otherwise("land")
        )
    return state.select("job_date", action.alias("action"), "run_status")
