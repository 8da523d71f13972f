"""Hourly summary of a stream that late ticks correct, from stored partial sums.

Every batch stores the sums of its own ticks per date, symbol, message code and hour, in a
partition of its own below each date. The summary of the dates it touched is then the sum of
all their partial sums. So an hour is there as soon as it has a tick, a tick that comes hours
or weeks late corrects it, and nothing waits for a watermark or is dropped by one. A batch
reads the partial sums of its dates, never their ticks, and keeps no state in memory.

Partial sums of a date are folded into one partition when there are many. A partition is named
by the first and the last batch it holds; one that a wider one covers counts no more and is
deleted. A batch or a fold that is repeated writes the same partitions again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.days import calendar_rows
from tickloom.operators.rollup import coarser, tick_summary
from tickloom.schemas import DATE_KEY, SUMMARY, SUMMARY_KEYS
from tickloom.sinks.tables import WriteWatch, batch_dates, write_table
from tickloom.sinks.upkeep import delete_files
from tickloom.sources.files import list_files
from tickloom.sources.tables import read_dates

#: Partitions of a date from which on they are folded.
FOLD = 16

_SPAN = ["first_batch", "last_batch"]
_PARTIALS = T.StructType([*SUMMARY.fields, *[T.StructField(name, T.LongType()) for name in _SPAN]])


def _files(spark: SparkSession, path: str, dates: list[dt.date]) -> DataFrame:
    """(path, date, first_batch, last_batch) of the files of some dates."""
    chosen = ",".join(sorted({day.isoformat() for day in dates}))
    listing = list_files(spark, f"{path}/{DATE_KEY}={{{chosen}}}", "*.parquet")
    named = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return listing.select(
        "path", named(DATE_KEY).cast("date").alias(DATE_KEY), *[named(name).cast("long").alias(name) for name in _SPAN]
    )


def _live_spans(spark: SparkSession, path: str, dates: list[dt.date]) -> DataFrame:
    """(date, first_batch, last_batch) of the partitions of some dates that no other covers."""
    spans = _files(spark, path, dates).drop("path").distinct()
    # A fold takes all that is live, so the one that reaches furthest covers all before it.
    folded = spans.where("last_batch > first_batch").groupBy(DATE_KEY).agg(
        F.max(F.struct("last_batch", (-F.col("first_batch")).alias("back"))).alias("fold")
    )
    is_fold = (F.col("last_batch") == F.col("fold.last_batch")) & (F.col("first_batch") == -F.col("fold.back"))
    live = F.col("fold").isNull() | is_fold | (F.col("first_batch") > F.col("fold.last_batch"))
    return spans.join(folded, DATE_KEY, "left").where(live).select(DATE_KEY, *_SPAN)


def _sums(spark: SparkSession, path: str, dates: list[dt.date]) -> DataFrame:
    """The summary of some dates from their live partial sums."""
    partials = read_dates(spark, path, dates, _PARTIALS)
    # At most FOLD rows per date, and dates are bound by the calendar.
    live = F.broadcast(_live_spans(spark, path, dates))
    return coarser(partials.join(live, [DATE_KEY, *_SPAN]), *SUMMARY_KEYS).select(*SUMMARY.fieldNames())


def _store(sums: DataFrame, path: str) -> None:
    (
        sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_KEY, *_SPAN).parquet(path)
    )


def fold(spark: SparkSession, path: str, dates: list[dt.date], least: int = FOLD) -> list[dt.date]:
    """Merge the partial sums of those dates that have at least so many partitions; returns these dates."""
    live = _live_spans(spark, path, dates).groupBy(DATE_KEY).agg(
        F.count("*").alias("n"), F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch")
    )
    spans = calendar_rows(live.where((F.col("n") >= least) & (F.col("last_batch") > F.col("first_batch"))))
    if not spans:
        return []
    days = sorted(row[DATE_KEY] for row in spans)
    wanted = F.broadcast(spark.createDataFrame(
        [(r[DATE_KEY], r.first_batch, r.last_batch) for r in spans], f"{DATE_KEY} date, first_batch long, last_batch long"
    ))
    _store(_sums(spark, path, days).join(wanted, DATE_KEY), path)
    covered = _files(spark, path, days).join(wanted, [DATE_KEY, *_SPAN], "left_anti")
    delete_files(covered).write.format("noop").mode("overwrite").save()
    return days


def correct_hours(ticks: DataFrame, partials: str, summary: str, checkpoint: str, least: int = FOLD) -> StreamingQuery:
    """Bring the summary up to date with the typed ticks of a stream, then stop.

    ``partials`` is the folder of this stream's partial sums and no other's. Ticks without a date
    are left out. Rows of the summary for dates that the stream never touched stay as they are.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        span = [F.lit(batch_id).cast("long").alias(name) for name in _SPAN]
        sums = tick_summary(batch.where(F.col(DATE_KEY).isNotNull())).select(*SUMMARY.fieldNames(), *span)
        watch = WriteWatch(sums)
        _store(watch.watched, partials)
        dates = batch_dates(sums, watch)
        if dates:
            write_table(_sums(spark, partials, dates), summary)
            fold(spark, partials, dates, least)

    return (
        ticks.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
