"""The daily load: raw files to ticks, cancellations, rejects and summary.

A load replaces the days whose files it read, whole: a file's day is in its name or
folder. A row of another date than its file's is listed as a reject and touches no
other day; a day without rows any more is emptied; a day with an unreadable file is left
as it is. Rejects are kept by the file's day too, with the file and member they came from.

Archives are unpacked and parsed once, into a staged table in which each line has its
outcome: kept, repaired, stray, without a date, without a symbol, or a repeated header.
Its control totals must add up to the lines that the reading tasks counted. Ticks, rejects
and totals are then published from the staged table, and only days in order are touched.

Unpacked text is parsed by the write of the typed table. That write also reports
which dates it touched and how many rows did not parse; rejects cost a second pass
over the text only when there are some. Later steps read the typed table back,
restricted to those dates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.functions.days import calendar_rows, day_key
from tickloom.functions.register import register_functions
from tickloom.operators import clean
from tickloom.operators.rollup import tick_summary
from tickloom.schemas import CANCELS, DATE_KEY, RAW_TICK_COLUMNS, RUN_LOG, SUMMARY, TICKS
from tickloom.session import fresh_dir
from tickloom.sinks.tables import WriteWatch, batch_dates, write_csv, write_table
from tickloom.sinks.upkeep import drop_partitions
from tickloom.sources.archives import read_checked_ticks
from tickloom.sources.delimited import read_cancels, read_ticks
from tickloom.sources.files import list_files
from tickloom.sources.rawzone import (
    CANCEL_GLOB, CANCEL_NAME, TICK_NAME, day_folder, file_day, files_of_days, raw_listing,
)
from tickloom.sources.tables import read_dates, read_or_empty


@dataclass(frozen=True)
class Lake:
    """Folders of the published tables."""

    root: str

    @property
    def ticks(self) -> str:
        return f"{self.root}/ticks"

    @property
    def cancels(self) -> str:
        return f"{self.root}/trade_cancellations"

    @property
    def summary(self) -> str:
        return f"{self.root}/ticks_summary"

    @property
    def summary_csv(self) -> str:
        return f"{self.root}/ticks_summary_csv"

    @property
    def runs(self) -> str:
        return f"{self.root}/ingestion_runs"

    @property
    def file_errors(self) -> str:
        return f"{self.root}/file_errors"

    @property
    def totals(self) -> str:
        """Lines of each loaded archive member by outcome, by the file's day."""
        return f"{self.root}/load_totals"

    @property
    def ticks_csv(self) -> str:
        return f"{self.root}/ticks_csv"

    @property
    def cancels_csv(self) -> str:
        return f"{self.root}/trade_cancellations_csv"

    def rejects(self, kind: str) -> str:
        return f"{self.root}/rejects/{kind}"


@dataclass(frozen=True)
class Loaded:
    """Result of a load: replaced dates, counts, and files that could not be read.

    ``rows`` went to the table; ``rejected`` rows have a defect, whether or not they
    did. ``file_errors`` has (path, error) rows, one per file; it stays distributed.
    """

    dates: list[dt.date] = field(default_factory=list)
    rows: int = 0
    rejected: int = 0
    file_errors: DataFrame | None = None


@dataclass(frozen=True)
class Feed:
    """How the rows of one kind of raw file are cleaned and judged."""

    schema: StructType
    clean: Callable[..., DataFrame]
    checks: Callable[..., dict[str, Column]]
    rejects: Callable[..., DataFrame]


TICK_FEED = Feed(TICKS, clean.clean_ticks, clean.tick_checks, clean.reject_ticks)
CANCEL_FEED = Feed(CANCELS, clean.clean_cancels, clean.cancel_checks, clean.reject_cancels)


TICK_GLOB = "*.csv"

# Where a raw row came from: its file, the archive member, what its rejects are
# replaced by, and the day the file is for, if it is for one.
ORIGIN = {"path": "string", "member": "string", "origin": "string", "file_day": "date"}


def _load(
    feed: Feed, raw: DataFrame, path: str, rejects_path: str, cluster: bool,
    origins: list[str], days: list[dt.date] | None,
) -> Loaded:
    """Load raw rows with the columns of ``ORIGIN``.

    ``days`` are the days to replace, also by nothing; without them, those of the rows.
    """
    spark = raw.sparkSession
    flag = clean.flawed(feed.checks(of_file=True)).alias("_flawed")
    cleaned = feed.clean(raw, flag, F.col("file_day"))
    stray = F.col(DATE_KEY).isNull() | F.coalesce(F.col(DATE_KEY) != F.col("file_day"), F.lit(False))
    cleaned = cleaned.withColumn("_day", F.when(~stray, F.col(DATE_KEY)))
    watch = WriteWatch(cleaned, "_day", flawed=F.col("_flawed"), kept=F.col("_day").isNotNull())
    typed = watch.watched.where(F.col("_day").isNotNull()).select(*feed.schema.fieldNames())
    write_table(typed, path, cluster=cluster)
    counts = watch.counts
    drop_partitions(spark, rejects_path, "origin", origins)
    if counts["flawed"]:
        write_table(feed.rejects(raw, of_file=True), rejects_path, cluster=False, key="origin")
    found = batch_dates(cleaned, watch, "_day")
    if days is not None:
        drop_partitions(spark, path, DATE_KEY, sorted({str(d) for d in days} - {str(d) for d in found}))
    return Loaded(sorted(days) if days is not None else found, counts["kept"], counts["flawed"])


def _unplaced(raw: DataFrame, load_id: str) -> DataFrame:
    """Raw rows that are from no file that is known."""
    values = {"origin": F.lit(load_id)}
    return raw.withColumns({n: values.get(n, F.lit(None)).cast(kind) for n, kind in ORIGIN.items() if n not in raw.columns})


VIEWS = {
    "ticks": ("ticks", TICKS), "trade_cancellations": ("cancels", CANCELS), "ticks_summary": ("summary", SUMMARY),
    "ingestion_runs": ("runs", RUN_LOG),
}


def register_views(spark: SparkSession, lake: Lake) -> None:
    """Make the published tables known to SQL under their usual names, and the SQL functions.

    A table that does not exist yet is empty.
    """
    register_functions(spark)
    for name, (attribute, schema) in VIEWS.items():
        read_or_empty(spark, getattr(lake, attribute), schema).createOrReplaceTempView(name)


def load_ticks(
    raw: DataFrame, lake: Lake, load_id: str, cluster: bool = True, as_csv: bool = False
) -> Loaded:
    """Raw ticks that hold whole days to the tick table, rejects and the summary of these days.

    Repeating a load of the same id replaces its rejects, also by none.
    """
    done = _load(TICK_FEED, _unplaced(raw, load_id), lake.ticks, lake.rejects("ticks"), cluster, [load_id], None)
    refresh_summary(raw.sparkSession, lake, done.dates, as_csv)
    return done


def load_cancels(raw: DataFrame, lake: Lake, load_id: str, cluster: bool = True) -> Loaded:
    """Raw cancellations that hold whole days to their table and rejects."""
    return _load(CANCEL_FEED, _unplaced(raw, load_id), lake.cancels, lake.rejects("cancels"), cluster, [load_id], None)


def refresh_summary(
    spark: SparkSession, lake: Lake, dates: list[dt.date], as_csv: bool = False
) -> None:
    """Recompute the summary of some dates from the tick table and replace them.

    ``as_csv`` also writes summary and ticks of these dates as text.
    """
    if not dates:
        return
    ticks = read_dates(spark, lake.ticks, dates, TICKS)
    write_table(tick_summary(ticks), lake.summary)
    gone = sorted({str(d) for d in dates} - {str(r[0]) for r in calendar_rows(ticks.select(DATE_KEY).distinct())})
    drop_partitions(spark, lake.summary, DATE_KEY, gone)
    if as_csv:
        write_csv(read_dates(spark, lake.summary, dates, SUMMARY), lake.summary_csv)
        write_csv(ticks, lake.ticks_csv)
        for path in (lake.summary_csv, lake.ticks_csv):
            drop_partitions(spark, path, DATE_KEY, gone)


def _dealt(listing: DataFrame) -> DataFrame:
    """Listed files with their day and the key of their rejects: the day, else the folder."""
    return listing.withColumn("file_day", file_day(F.col("path"))).withColumn("origin", _origin())


def _origin() -> Column:
    path = F.col("path")
    return F.coalesce(day_key(file_day(path)), F.concat(F.lit("folder-"), F.hex(F.xxhash64(day_folder(path)))))


def _per_day(files: DataFrame) -> tuple[list[str], list[dt.date] | None]:
    """Keys of rejects and days of the files; no days if a file is for none."""
    rows = calendar_rows(files.groupBy("origin", "file_day").agg(F.count("*").alias("files")))
    days = [row.file_day for row in rows]
    return [row.origin for row in rows], None if None in days else days


@dataclass(frozen=True)
class Staged:
    """Archives parsed once: all their lines, judged, and per member what became of them.

    ``totals`` has the lines that the reading task counted, next to the lines of each outcome, and
    an ``error`` for what cannot be read and for members whose counts do not add up.
    """

    lines: DataFrame
    totals: DataFrame

    @property
    def errors(self) -> DataFrame:
        return self.totals.where("error IS NOT NULL").groupBy("path").agg(F.min("error").alias("error"))


def stage_archives(spark: SparkSession, listing: DataFrame) -> Staged:
    """Unpack and parse the listed archives, each once, into a table of judged lines.

    Nothing of the lake is touched. A damaged member shows when it has been read to its end;
    what was parsed of it until then is left out when the lines are published.
    """
    path, totals_path = fresh_dir(spark, "staged-ticks"), fresh_dir(spark, "staged-totals")
    read = read_checked_ticks(listing)
    judged = clean.judged_ticks(_dealt(read.rows))
    judged = judged.withColumn("outcome", F.when(F.col("is_line"), F.col("outcome"))).drop("is_line")
    judged.write.parquet(path)
    staged = spark.read.parquet(path)
    per_member = staged.groupBy("path", "member", "file_day", "origin").agg(
        F.sum("lines").alias("lines"), F.max("error").alias("error"),
        *[F.count_if(F.col("outcome") == name).alias(name) for name in clean.OUTCOMES],
    )
    accounted = sum((F.col(name) for name in clean.OUTCOMES[1:]), F.col(clean.OUTCOMES[0]))
    unequal = F.concat(F.lit("lines read: "), "lines", F.lit(", accounted for: "), accounted)
    per_member = per_member.withColumn(
        "error", F.coalesce("error", F.when(~F.col("lines").eqNullSafe(accounted), unequal))
    )
    totals = per_member.unionByName(_dealt(read.errors), allowMissingColumns=True)
    totals.write.parquet(totals_path)
    return Staged(staged.where("outcome IS NOT NULL"), spark.read.parquet(totals_path))


def publish_staged(spark: SparkSession, staged: Staged, lake: Lake, as_csv: bool = False) -> Loaded:
    """Replace the days of staged archives, but for those with an archive in ``errors``."""
    lines_of = lambda group: F.sum(sum((F.col(name) for name in group[1:]), F.col(group[0])))
    units = calendar_rows(staged.totals.groupBy("origin", "file_day").agg(
        F.max(F.col("error").isNotNull()).alias("bad"),
        lines_of(clean.KEPT).alias("kept"), lines_of(clean.REJECTED).alias("rejected"),
    ))
    good, bad = [u for u in units if not u.bad], [u.origin for u in units if u.bad]
    if not good:
        return Loaded(file_errors=staged.errors)
    in_order = ~F.col("origin").isin(bad) if bad else F.lit(True)
    lines = staged.lines.where(in_order)
    origins, days = [u.origin for u in good], [u.file_day for u in good]
    kept = lines.where(F.col("outcome").isin(clean.KEPT)).select(*TICKS.fieldNames())
    watch = WriteWatch(kept)
    # An archive holds one day, and the staged files hold few archives each, so the
    # write needs no shuffle to gather dates.
    write_table(watch.watched, lake.ticks, cluster=False)
    found = batch_dates(kept, watch)
    rejected = sum(u.rejected for u in good)
    drop_partitions(spark, lake.rejects("ticks"), "origin", [u.origin for u in good if not u.rejected])
    if rejected:
        rejects = lines.where(F.col("outcome").isin(clean.REJECTED)).select(
            *[F.col(f"reject.{name}") for name in RAW_TICK_COLUMNS], *ORIGIN, "reject.reasons"
        )
        write_table(rejects, lake.rejects("ticks"), cluster=False, key="origin")
    write_table(staged.totals.where(in_order).drop("error"), lake.totals, cluster=False, key="origin")
    if None in days:
        days = found
    drop_partitions(spark, lake.ticks, DATE_KEY, sorted({str(d) for d in days} - {str(d) for d in found}))
    refresh_summary(spark, lake, sorted(days), as_csv)
    return Loaded(sorted(days), sum(u.kept for u in good), rejected, staged.errors)


def load_archives(spark: SparkSession, listing: DataFrame, lake: Lake, as_csv: bool = False) -> Loaded:
    """Tick load of the listed archives, which must be all those of their days.

    A day with an unreadable archive is left as it is, and its files are reported.
    """
    return publish_staged(spark, stage_archives(spark, listing), lake, as_csv)


def record_file_errors(spark: SparkSession, lake: Lake, listing: DataFrame, done: Loaded) -> None:
    """Keep the files that a load could not read; those of its days before are forgotten."""
    origins, _ = _per_day(_dealt(listing))
    drop_partitions(spark, lake.file_errors, "origin", origins)
    if done.file_errors is not None:
        errors = done.file_errors.withColumn("origin", _origin())
        write_table(errors, lake.file_errors, cluster=False, key="origin")


def load_tick_files(spark: SparkSession, folders: list[str], lake: Lake) -> Loaded:
    """Tick load of all unpacked files of some folders, which hold whole days."""
    origins, days = _per_day(_dealt(list_files(spark, folders, TICK_GLOB)))
    raw = _dealt(read_ticks(spark, folders, TICK_GLOB, origin=True))
    done = _load(TICK_FEED, raw, lake.ticks, lake.rejects("ticks"), True, origins, days)
    refresh_summary(spark, lake, done.dates)
    return done


def run_tick_load(
    spark: SparkSession, raw_root: str, lake: Lake, days: DataFrame, as_csv: bool = False
) -> Loaded:
    """Tick load of the requested days. Days without an archive drop out."""
    listing = files_of_days(raw_listing(spark, raw_root, days), days, TICK_NAME)
    return load_archives(spark, listing.drop("job_date"), lake, as_csv)


def run_cancel_load(
    spark: SparkSession, raw_root: str, lake: Lake, days: DataFrame, as_csv: bool = False
) -> Loaded:
    """Cancellation load of the requested days."""
    files = _dealt(files_of_days(raw_listing(spark, raw_root, days), days, CANCEL_NAME))
    origins, found = _per_day(files)
    if not origins:
        return Loaded()
    # A glob of the days' folders, not a list of files: the driver holds days only.
    raw = read_cancels(spark, f"{raw_root}/{{{','.join(sorted(origins))}}}", CANCEL_GLOB, origin=True)
    # Each file holds one day, so the write needs no shuffle to gather dates.
    done = _load(CANCEL_FEED, _dealt(raw), lake.cancels, lake.rejects("cancels"), False, origins, found)
    if as_csv:
        write_csv(read_dates(spark, lake.cancels, done.dates, CANCELS), lake.cancels_csv)
    return done
