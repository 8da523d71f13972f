"""Dashboard and check queries over the summary.

Each takes the summary and, where a dashboard would, a ``Selection``. Predicates
stay on the summary's own columns, so the date range prunes partitions and the
rest reaches the Parquet scan. Sorts name their null order: descending puts nulls
first and ascending last, as the serving database does.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.days import market_time
from tickloom.operators.rollup import mean_price, vwap
from tickloom.schemas import DATE_KEY


@dataclass(frozen=True)
class Selection:
    """Choices of a dashboard user; ``None`` is "All" or an open end of the range.

    An empty list of symbols or codes is "All" too, as in the dashboard.
    """

    symbols: list[str] | None = None
    message_codes: list[str] | None = None
    first: dt.date | None = None
    last: dt.date | None = None

    def apply(self, summary: DataFrame) -> DataFrame:
        keep = _chosen("Symbol", self.symbols) & _chosen("MessageCode", self.message_codes)
        day = F.col(DATE_KEY)
        keep = keep & day.isNotNull()
        if self.first is not None:
            keep = keep & (day >= F.lit(self.first))
        if self.last is not None:
            keep = keep & (day <= F.lit(self.last))
        return summary.where(keep)


ALL = Selection()


def _chosen(name: str, values: list[str] | None) -> Column:
    # "All" lists every value, and a null is in no list.
    return F.col(name).isNotNull() if not values else F.col(name).isin(values)


def table_profile(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(DATE_KEY).alias("start_date"),
        F.max(DATE_KEY).alias("end_date"),
        F.count_distinct("Symbol").alias("unique_symbols"),
    )


def symbol_volume(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("Symbol")
        .agg(F.sum("GroupVolume").alias("total_volume"), F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc_nulls_first("total_volume"))
    )


def sample_rows(summary: DataFrame, n: int = 10) -> DataFrame:
    """The first rows by key, so that repeated looks show the same rows."""
    return summary.orderBy(DATE_KEY, "Symbol", "MessageCode", "Hour").limit(n)


def choices(summary: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column, for a drop-down list."""
    return summary.select(column).distinct().orderBy(F.asc_nulls_last(column))


def total_volume(summary: DataFrame, selection: Selection = ALL) -> DataFrame:
    return selection.apply(summary).agg(F.sum("GroupVolume").alias("Total Volume"))


def total_ticks(summary: DataFrame, selection: Selection = ALL) -> DataFrame:
    return selection.apply(summary).agg(F.sum("GroupTradeCount").alias("Total Ticks"))


def vwap_series(summary: DataFrame, selection: Selection = ALL) -> DataFrame:
    """Weighted average price and volume per hour on a continuous time axis."""
    hourly = selection.apply(summary).groupBy(
        market_time(F.col(DATE_KEY), F.col("Hour")).alias("time")
    ).agg(
        F.sum("GroupPriceVolume").alias("GroupPriceVolume"),
        F.sum("GroupVolume").alias("GroupVolume"),
    )
    return hourly.select(
        "time", vwap().alias("Weighted Avg Price"), F.col("GroupVolume").alias("Volume")
    ).orderBy(F.asc_nulls_last("time"))


def hourly_liquidity(summary: DataFrame, selection: Selection = ALL) -> DataFrame:
    return (
        selection.apply(summary).groupBy("Hour")
        .agg(F.sum("GroupVolume").alias("Total Volume"))
        .orderBy(F.asc_nulls_last("Hour"))
    )


def market_share(
    summary: DataFrame, selection: Selection = ALL, as_of: dt.datetime | None = None
) -> DataFrame:
    """Volume per symbol at one time stamp, largest first."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return (
        selection.apply(summary).groupBy("Symbol").agg(F.sum("GroupVolume").alias("value"))
        .select(now.alias("time"), F.col("Symbol").alias("metric"), "value")
        .orderBy(F.desc_nulls_first("value"))
    )


def with_share(shares: DataFrame, digits: int = 6) -> DataFrame:
    """Add each symbol's part of the whole, as a pie chart draws it.

    The total is a scalar subquery: no window over one partition, no join.
    """
    total = shares.agg(F.sum("value")).scalar()
    part = F.col("value").cast("double") / F.nullif(total, F.lit(0).cast("bigint"))
    return shares.withColumn("share", F.round(part, digits))


def trade_detail(summary: DataFrame, selection: Selection = ALL, n: int = 500) -> DataFrame:
    """The latest summary rows. Symbol and code break ties, so the cut is stable."""
    return (
        selection.apply(summary)
        .orderBy(
            F.desc_nulls_first(DATE_KEY), F.desc_nulls_first("Hour"),
            F.asc_nulls_last("Symbol"), F.asc_nulls_last("MessageCode"),
        )
        .limit(n)
        .select(
            F.col(DATE_KEY).alias("Date"), "Hour", "Symbol",
            F.col("MessageCode").alias("Type"),
            F.col("GroupVolume").alias("Volume"),
            F.col("GroupTradeCount").alias("Ticks"),
            vwap().alias("Avg Price"),
        )
    )


def mean_prices(summary: DataFrame, selection: Selection = ALL) -> DataFrame:
    """Unweighted mean trade price per symbol."""
    per_symbol = selection.apply(summary).groupBy("Symbol").agg(
        F.sum("GroupPriceSum").alias("GroupPriceSum"),
        F.sum("GroupTradeCount").alias("GroupTradeCount"),
    )
    return per_symbol.select("Symbol", mean_price().alias("mean_price"))
