"""Compaction of small files, and files past their retention."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.days import calendar_rows
from tickloom.schemas import DATE_KEY
from tickloom.session import fresh_dir, settings
from tickloom.sinks.tables import write_table
from tickloom.sources.files import few_tasks, list_files, locate, per_row
from tickloom.sources.tables import read_dates

TARGET_BYTES = 1 << 30
RETENTION_HOURS = 168
# Row groups of clustered files: the smallest part of a file that a filter can skip.
ROW_GROUP_BYTES = 16 << 20
FILTER_VALUES = 10_000

_SPLIT = "spark.sql.files.maxPartitionBytes"
_OPEN_COST = "spark.sql.files.openCostInBytes"


def partition_sizes(listing: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Files and bytes of each date partition."""
    day = F.regexp_extract("path", f"/{key}=([^/]+)/", 1).try_cast("date")
    return (
        listing.select(day.alias(key), "length").where(F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def fragmented(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Partitions with more files than their size calls for, and that number."""
    wanted = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    return sizes.withColumn("wanted", wanted).where(F.col("files") > F.col("wanted"))


def regrouped(rows: DataFrame, wanted: dict[dt.date, int], key: str = DATE_KEY) -> DataFrame:
    """Rows shuffled so that each date ends in at most its wanted number of tasks.

    A date gets as many salts as it should have files, so a date that holds much
    of the table is written by many tasks. Twice as many tasks as salts keeps two
    salts from often sharing one.
    """
    plan = rows.sparkSession.createDataFrame(list(wanted.items()), f"{key} date, _files int")
    # One plan row per date, so the broadcast is bounded by the calendar.
    # By place in a task, so that equal rows are spread as well. A retried task reads the
    # same files in the same order.
    salted = rows.join(F.broadcast(plan), key).withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), F.col("_files"))
    )
    tasks = 2 * sum(wanted.values())
    return salted.repartition(tasks, key, "_salt").select(*rows.columns)


def compact(
    spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES
) -> list[dt.date]:
    """Rewrite fragmented date partitions into files of about the target size.

    Rows are staged first: Spark must not read the partitions it overwrites, and a
    failed run leaves either the old files or the staged copy. Returns the dates.
    Not for the folder of a streaming file sink, whose log names its files.
    """
    picked = fragmented(partition_sizes(list_files(spark, path, "*.parquet")), target_bytes)
    wanted = {row[DATE_KEY]: row.wanted for row in calendar_rows(picked)}
    if not wanted:
        return []
    dates = sorted(wanted)
    staged = fresh_dir(spark, "compact")
    rows = read_dates(spark, path, dates)
    write_table(regrouped(rows, wanted), staged, cluster=False)
    # The staged files are final. With the cost of opening a file as high as the
    # split size, a scan task takes exactly one file, so the copy needs no shuffle
    # and keeps the number of files.
    split = 2 * target_bytes
    with settings(spark, **{_SPLIT: split, _OPEN_COST: split}):
        write_table(spark.read.parquet(staged), path, cluster=False)
    return dates


def cluster(
    spark: SparkSession, path: str, dates: list[dt.date], by: list[str], target_bytes: int = TARGET_BYTES,
    row_group_bytes: int = ROW_GROUP_BYTES, filter_values: int = FILTER_VALUES,
) -> None:
    """Rewrite some dates so that a filter on the first of the ``by`` columns skips most of them.

    Rows of a date are dealt into ranges of the columns and sorted by them, so each row group
    spans few values, and a Bloom filter tells which of the others it does not hold. The later
    columns split a value that holds much of a date. Ranges run on from date to date: a date
    may get one file more than its size calls for. ``filter_values`` is how many different
    values a filter is laid out for. Staged and published like ``compact``.
    """
    chosen = ",".join(sorted({day.isoformat() for day in dates}))
    sizes = partition_sizes(list_files(spark, f"{path}/{DATE_KEY}={{{chosen}}}", "*.parquet"))
    wanted = {row[DATE_KEY]: -(-row.bytes // target_bytes) for row in calendar_rows(sizes)}
    if not wanted:
        return
    options = {
        f"parquet.bloom.filter.enabled#{by[0]}": "true",
        f"parquet.bloom.filter.expected.ndv#{by[0]}": str(filter_values),
        "parquet.block.size": str(row_group_bytes),
    }

    def write(rows: DataFrame, target: str) -> None:
        # The order by date is what the writer asks for, so it adds no sort of its own.
        ordered = rows.sortWithinPartitions(DATE_KEY, *by)
        (
            ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .options(**options).partitionBy(DATE_KEY).parquet(target)
        )

    staged = fresh_dir(spark, "cluster")
    rows = read_dates(spark, path, sorted(wanted))
    write(rows.repartitionByRange(sum(wanted.values()), DATE_KEY, *by), staged)
    split = 2 * target_bytes
    with settings(spark, **{_SPLIT: split, _OPEN_COST: split}):
        write(spark.read.parquet(staged), path)


def retention_candidates(
    listing: DataFrame, live: DataFrame, now: dt.datetime, hours: int = RETENTION_HOURS
) -> DataFrame:
    """Listed files that no live table uses and that are older than the retention."""
    oldest_kept = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    old = listing.where(F.col("modificationTime") < oldest_kept)
    return old.join(live.select("path"), "path", "left_anti")


def delete_files(candidates: DataFrame) -> DataFrame:
    """Delete the candidates in parallel; one row per file with its outcome.

    Nothing is deleted until an action runs on the result. A file that is gone
    already counts as deleted, so a retried task does no harm.
    """

    def remove(row: dict):
        system, path = locate(row["path"])
        error = None
        try:
            system.delete_file(path)
        except FileNotFoundError:
            pass
        except OSError as problem:
            error = str(problem)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["path"]], pa.string()), pa.array([error], pa.string())],
            names=["path", "error"],
        )

    return few_tasks(candidates.select("path")).mapInArrow(
        per_row(remove), "path string, error string"
    )


def drop_partitions(spark: SparkSession, path: str, key: str, values: list[str]) -> None:
    """Delete the files of some partitions of a table; those that have none are left alone."""
    if values:
        gone = list_files(spark, f"{path}/{key}={{{','.join(values)}}}")
        delete_files(gone).write.format("noop").mode("overwrite").save()
