"""The hourly roll-up of ticks and its re-aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.cells import hour_bucket
from tickloom.functions.pricing import exact_ratio, weighted_price
from tickloom.schemas import SUMMARY_KEYS


def tick_summary(ticks: DataFrame, *more_keys: Column) -> DataFrame:
    """Volume, trade count and price sums per date, symbol, message code and hour.

    Plans as partial aggregation, one shuffle and final aggregation, so a symbol
    that holds much of the data reaches the shuffle as one row per task and hour.
    ``sum`` skips nulls: a tick without price counts in volume, not in price times
    volume.
    """
    keys = [hour_bucket("TradeTime").alias(k) if k == "Hour" else F.col(k) for k in SUMMARY_KEYS]
    return ticks.groupBy(*keys, *more_keys).agg(
        F.sum("TradeVolume").alias("GroupVolume"),
        F.count(F.lit(1)).alias("GroupTradeCount"),
        F.sum(F.col("TradePrice") * F.col("TradeVolume")).alias("GroupPriceVolume"),
        F.sum("TradePrice").alias("GroupPriceSum"),
    )


def coarser(summary: DataFrame, *keys: str | Column) -> DataFrame:
    """Summary at a coarser grain: sums of the group sums.

    Averages are taken from the result, never averaged themselves.
    """
    return summary.groupBy(*keys).agg(
        F.sum("GroupVolume").alias("GroupVolume"),
        F.sum("GroupTradeCount").alias("GroupTradeCount"),
        F.sum("GroupPriceVolume").cast("decimal(38,4)").alias("GroupPriceVolume"),
        F.sum("GroupPriceSum").cast("decimal(28,4)").alias("GroupPriceSum"),
    )


def vwap() -> Column:
    """Volume-weighted average price of a summary row."""
    return weighted_price(F.col("GroupPriceVolume"), F.col("GroupVolume"))


def mean_price() -> Column:
    """Price averaged over the trades of a summary row."""
    return exact_ratio(F.col("GroupPriceSum"), F.col("GroupTradeCount"))
