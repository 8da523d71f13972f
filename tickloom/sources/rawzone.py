"""The raw zone: one folder per day, ``<root>/<yyyymmdd>/``, holding that day's files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.days import calendar_rows, day_key
from tickloom.schemas import FAILED, LISTING, SUCCESS
from tickloom.sources.files import list_files

# File names of the exchange's daily drop. The first two carry the
# day, inserted before the extension.
TICK_FILE, CANCEL_FILE = "WEBPXTICK_DT.zip", "TC.txt"
STRUCTURE_FILES = ["TickData_structure.dat", "TC_structure.dat"]

# How a day shows in the names of the two data files.
TICK_NAME = r"/WEBPXTICK_DT_(\d{8})\.zip$"
CANCEL_NAME = r"/TC_(\d{8})\.txt$"
CANCEL_GLOB = "TC_*.txt"


def _day_in(path: Column, pattern: str) -> Column:
    return F.try_to_date(F.regexp_extract(path, pattern, 1), "yyyyMMdd")


def file_day(path: Column) -> Column:
    """The day a file is for: the one in its name, else that of the innermost day folder, else null."""
    return F.coalesce(
        _day_in(path, TICK_NAME), _day_in(path, CANCEL_NAME), _day_in(path, r"^.*/(\d{8})/")
    )


def day_folder(path: Column) -> Column:
    """The innermost day folder of a file, else the folder it is in."""
    path = F.regexp_replace(path, "^file:/+", "file:/")
    folder = F.regexp_extract(path, r"^(.*/\d{8})/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"^(.*)/", 1))


def dated_name(filename: Column, day: Column) -> Column:
    """File name with the day put before its extension."""
    return F.regexp_replace(filename, F.lit(r"\."), F.concat(F.lit("_"), day_key(day), F.lit(".")))


def raw_listing(spark: SparkSession, root: str, days: DataFrame) -> DataFrame:
    """Files in the folders of the requested days; other days are not listed."""
    keys = [row[0] for row in calendar_rows(days.select(day_key(F.col("job_date"))))]
    if not keys:
        return spark.createDataFrame([], LISTING)
    return list_files(spark, f"{root}/{{{','.join(sorted(keys))}}}")


def completeness(listing: DataFrame) -> DataFrame:
    """Per day: whether the tick archive and the cancellation file are there.

    A day is complete with both; structure files are not required.
    """
    # At most one of the two matches; the other gives empty text.
    tick_day = F.regexp_extract("path", TICK_NAME, 1)
    cancel_day = F.regexp_extract("path", CANCEL_NAME, 1)
    named = listing.select(
        F.try_to_date(F.concat(tick_day, cancel_day), "yyyyMMdd").alias("job_date"),
        (tick_day != "").alias("is_tick"),
    )
    return (
        named.where("job_date is not null").groupBy("job_date")
        .agg(F.max("is_tick").alias("has_ticks"), F.max(~F.col("is_tick")).alias("has_cancels"))
        .withColumn("complete", F.col("has_ticks") & F.col("has_cancels"))
    )


def days_with(days: DataFrame, complete: DataFrame, what: str = "has_ticks") -> DataFrame:
    """Requested days whose file of the given kind is there."""
    return days.join(complete.where(what), "job_date", "left_semi")


def days_missing(days: DataFrame, complete: DataFrame, what: str = "complete") -> DataFrame:
    """Requested days still to be fetched."""
    return days.join(complete.where(what), "job_date", "left_anti")


def landing_manifest(days: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per expected file of each requested day, with its landing status."""
    templates = F.array(
        *[dated_name(F.lit(name), F.col("job_date")) for name in (TICK_FILE, CANCEL_FILE)],
        *[F.lit(name) for name in STRUCTURE_FILES],
    )
    expected = days.select("job_date", F.explode(templates).alias("filename"))
    present = listing.select(
        _day_in(F.col("path"), r"^.*/(\d{8})/").alias("job_date"),
        F.substring_index("path", "/", -1).alias("filename"),
        F.lit(True).alias("found"),
    ).distinct()
    return expected.join(present, ["job_date", "filename"], "left").select(
        "job_date",
        "filename",
        F.when(F.col("found"), SUCCESS).otherwise(FAILED).alias("status"),
        F.when(F.col("found").isNull(), "file not found").alias("error"),
        F.when(F.col("found"), "Already exists").alias("info"),
    )


def files_of_days(listing: DataFrame, days: DataFrame, name_pattern: str) -> DataFrame:
    """Listed files of one kind for the requested days; days without one drop out."""
    day = F.try_to_date(F.regexp_extract("path", name_pattern, 1), "yyyyMMdd")
    return listing.withColumn("job_date", day).join(days, "job_date", "left_semi")
