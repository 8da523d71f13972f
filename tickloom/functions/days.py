"""Column expressions for business days and market time (Monday to Friday weeks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

# Days a four-digit year can name; bounds everything that has one row per day.
CALENDAR_DAYS = 3_652_059


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def day_key(day: Column) -> Column:
    """``yyyyMMdd`` text, as used in raw folder and file names."""
    return F.date_format(day, "yyyyMMdd")


def weekdays_until(day: Column) -> Column:
    """Weekdays from Monday 1969-12-29 up to and including ``day``.

    Closed form: five per whole week plus the days of the last one. Differences
    of two such counts replace a loop over the days between them.
    """
    n = F.unix_date(day) + 3
    since_monday = F.pmod(n, F.lit(7))
    weeks = F.call_function("div", n - since_monday, F.lit(7))
    return weeks * 5 + F.least(since_monday + 1, F.lit(5))


def business_days(start: Column, end: Column, inclusive: bool = True) -> Column:
    """Signed number of weekdays between two dates; 0 for equal dates.

    ``inclusive`` also counts the earlier date when it is a weekday; without it
    only the days after the earlier date count.
    """
    first, last = F.least(start, end), F.greatest(start, end)
    steps = weekdays_until(last) - weekdays_until(first)
    if inclusive:
        steps = steps + F.when(is_weekday(first), 1).otherwise(0)
    return F.when(start == end, 0).when(start > end, -steps).otherwise(steps).cast("int")


def market_time(day: Column, hour: Column) -> Column:
    """Start of the hour as a zone-free timestamp; hours beyond 23 run into later days."""
    hours = hour.try_cast("int")
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)


def calendar_rows(per_day: DataFrame) -> list[Row]:
    """Rows of a frame that has at most one per day, on the driver."""
    # One partition, so that the limit is taken in one job.
    rows = per_day.repartition(1).limit(CALENDAR_DAYS + 1).collect()
    if len(rows) > CALENDAR_DAYS:
        raise ValueError("more rows than days in the calendar")
    return rows
