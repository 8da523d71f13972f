"""Incremental loads: every new raw file once, or each touched day replaced whole."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.days import calendar_rows
from tickloom.operators.clean import clean_ticks, dated, flawed, reject_ticks, tick_checks
from tickloom.operators.rollup import tick_summary
from tickloom.plans.daily import Lake, load_archives, load_tick_files, record_file_errors
from tickloom.schemas import BINARY_FILE, DATE_KEY, LISTING, RAW_TICKS, SUMMARY
from tickloom.sinks.tables import WriteWatch
from tickloom.sources.files import list_files
from tickloom.sources.rawzone import day_folder


def tick_stream(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """Stream of raw ticks, with their ``path``, from unpacked files arriving below ``folder``.

    A stream has one schema, so all files share the declared column order; a file
    with another header fails the batch instead of shifting its cells.
    """
    reader = (
        spark.readStream.schema(RAW_TICKS).option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.csv(folder).select("*", F.col("_metadata.file_path").alias("path"))


def load_new_files(raw: DataFrame, out: str, rejects: str, checkpoint: str) -> StreamingQuery:
    """Append the ticks of files not seen before, and their rejects, then stop.

    The checkpoint remembers the files of each batch. A batch writes partitions of its
    own, named by checkpoint and batch, so one that is repeated writes them again.
    """
    name = f"{zlib.crc32(checkpoint.encode()):08x}"

    def publish(batch: DataFrame, batch_id: int) -> None:
        load = F.lit(f"{name}-{batch_id}").alias("load")
        flag = flawed(tick_checks()).alias("_flawed")
        watch = WriteWatch(clean_ticks(batch, flag, load), flawed=F.col("_flawed"))
        ticks = dated(watch.watched).drop("_flawed")
        _into(ticks, out, "load", DATE_KEY)
        if watch.counts["flawed"]:
            _into(reject_ticks(batch).select("*", load), rejects, "load")

    return (
        raw.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _into(rows: DataFrame, path: str, *keys: str) -> None:
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def _day_folders(files: DataFrame) -> list[str]:
    """The folders of the days that files are for; one per day."""
    return [row.folder for row in calendar_rows(files.select(day_folder(F.col("path")).alias("folder")).distinct())]


def replace_days(raw: DataFrame, lake: Lake, checkpoint: str) -> StreamingQuery:
    """Replace the days whose folders got new files, in ticks, rejects and summary.

    A batch loads its days' folders whole, so a day may arrive in any number of files
    and batches. A file's folder is its day's, or if no folder is named by a day, the one
    it lies in; then the dates of its rows are replaced. A batch that is repeated after a
    failure writes the same partitions again.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        load_tick_files(batch.sparkSession, _day_folders(batch), lake)

    return (
        raw.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def archive_stream(spark: SparkSession, raw_root: str, per_batch: int | None = None) -> DataFrame:
    """Stream of tick archives arriving in the raw zone, as a listing.

    Only the listing's columns are selected, so contents are not read here.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip")
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(raw_root).select(*LISTING.fieldNames())


def replace_days_from_archives(
    archives: DataFrame, lake: Lake, checkpoint: str
) -> StreamingQuery:
    """Load new archives as they arrive, each with all others of its day's folder.

    A day with a damaged archive stays as it is and does not hold up the others; the
    archive is listed below ``file_errors`` of the lake until the day loads.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folders = _day_folders(batch)
        listing = list_files(spark, folders, "*.zip")
        done = load_archives(spark, listing, lake)
        record_file_errors(spark, lake, listing, done)

    return (
        archives.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def hourly_summary(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Running summary of a tick stream per event-time hour.

    An hour is emitted once the watermark has passed its end; later ticks for it
    are late. State holds the open hours only. Watermarks need an instant, so the
    market's clock is read as UTC whatever the session's zone; ticks whose clock
    is no time of day have no event time and do not appear.
    """
    clock = F.lpad(F.replace("TradeTime", F.lit(":"), F.lit("")), 6, "0")
    parts = [F.substring(clock, at, 2) for at in (1, 3, 5)]
    text = F.concat(F.col(DATE_KEY).cast("string"), F.lit(" "), F.concat_ws(":", *parts), F.lit("Z"))
    timed = ticks.withColumn("at", text.try_cast("timestamp")).withWatermark("at", delay)
    # Date and hour text are one to one with the window, and keep its stored form.
    hours = tick_summary(timed, F.window("at", "1 hour"))
    return hours.select(*SUMMARY.fieldNames())
