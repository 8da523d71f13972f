"""Day and month levels of the summary, and date ranges made up of them.

The levels hold the summary's sums per symbol and message code by day and by month. They are kept
up by the dates that a load touched: those days are summed again from the summary, then their
months from the days. A range of dates is covered by its whole months and the days at its edges, so
a panel over years reads one row per month, symbol and code, and the few days that months do not cover.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.days import calendar_rows
from tickloom.operators.panels import ALL, Selection
from tickloom.operators.rollup import coarser
from tickloom.schemas import DATE_KEY, SUMMARY
from tickloom.sinks.tables import WriteWatch, batch_dates, write_table
from tickloom.sinks.upkeep import drop_partitions
from tickloom.sources.tables import read_dates, read_or_empty

MONTH_KEY = "Month"
_ONE_DAY = dt.timedelta(days=1)
_DAYS = T.StructType([field for field in SUMMARY if field.name != "Hour"])
_MONTHS = T.StructType([
    T.StructField(MONTH_KEY, T.DateType()) if field.name == DATE_KEY else field for field in _DAYS
])


@dataclass(frozen=True)
class Levels:
    """Folders of the levels."""

    root: str

    @property
    def days(self) -> str:
        return f"{self.root}/summary_days"

    @property
    def months(self) -> str:
        return f"{self.root}/summary_months"


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + 4 * _ONE_DAY).replace(day=1)


def _dates(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + n * _ONE_DAY for n in range((last - first).days + 1)]


def refresh_levels(spark: SparkSession, summary: str, levels: Levels, dates: list[dt.date]) -> list[dt.date]:
    """Sum the levels again for dates whose summary changed; returns the months that were rewritten.

    A day or month that has no row any more is emptied. A refresh can be repeated.
    """
    if not dates:
        return []
    days = coarser(read_dates(spark, summary, dates, SUMMARY), DATE_KEY, "Symbol", "MessageCode")
    watch = WriteWatch(days)
    write_table(watch.watched.select(*_DAYS.fieldNames()), levels.days)
    gone = {str(d) for d in dates} - {str(d) for d in batch_dates(days, watch)}
    drop_partitions(spark, levels.days, DATE_KEY, sorted(gone))

    months = sorted({day.replace(day=1) for day in dates})
    of_months = [day for month in months for day in _dates(month, _next_month(month) - _ONE_DAY)]
    month = F.trunc(DATE_KEY, "month").alias(MONTH_KEY)
    sums = coarser(read_dates(spark, levels.days, of_months, _DAYS), month, "Symbol", "MessageCode")
    watch = WriteWatch(sums, MONTH_KEY)
    write_table(watch.watched.select(*_MONTHS.fieldNames()), levels.months, key=MONTH_KEY)
    gone = {str(m) for m in months} - {str(m) for m in batch_dates(sums, watch, MONTH_KEY)}
    drop_partitions(spark, levels.months, MONTH_KEY, sorted(gone))
    return months


def all_dates(summary: DataFrame) -> list[dt.date]:
    """The dates of a summary, for the first refresh."""
    return sorted(row[0] for row in calendar_rows(summary.select(DATE_KEY).where(F.col(DATE_KEY).isNotNull()).distinct()))


def cover(first: dt.date, last: dt.date) -> tuple[tuple[dt.date, dt.date] | None, list[tuple[dt.date, dt.date]]]:
    """A range of dates as the first and last of its whole months, if any, and the ranges of days at its edges."""
    if first > last:
        return None, []
    start = first if first.day == 1 else _next_month(first)
    stop = (last + _ONE_DAY).replace(day=1)  # the month that is not whole any more
    if start >= stop:
        return None, [(first, last)]
    edges = [(first, start - _ONE_DAY), (stop, last)]
    return (start, (stop - _ONE_DAY).replace(day=1)), [(a, b) for a, b in edges if a <= b]


def range_rows(spark: SparkSession, levels: Levels, first: dt.date, last: dt.date) -> DataFrame:
    """Sums that add up to those of a date range; a month's rows carry its first day as their date."""
    months, edges = cover(first, last)
    rows = spark.createDataFrame([], _DAYS)
    if months:
        whole = read_or_empty(spark, levels.months, _MONTHS).where(F.col(MONTH_KEY).between(*map(F.lit, months)))
        rows = rows.unionByName(whole.withColumnRenamed(MONTH_KEY, DATE_KEY))
    for edge in edges:
        # At most a month's days at either end: only their folders are listed.
        rows = rows.unionByName(read_dates(spark, levels.days, _dates(*edge), _DAYS))
    return rows


def total_volume_range(
    spark: SparkSession, levels: Levels, first: dt.date, last: dt.date, selection: Selection = ALL
) -> DataFrame:
    """Total volume of a date range and a choice of symbols and codes."""
    rows = selection.apply(range_rows(spark, levels, first, last))
    return rows.agg(F.sum("GroupVolume").alias("Total Volume"))
