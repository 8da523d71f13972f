"""Exact price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_ratio(amount: Column, units: Column) -> Column:
    """``amount / units`` to four decimals, rounded half away from zero.

    Decimal division would round once at the quotient's scale and again at four
    decimals, and narrows its operands for large sums. Whole-number division and
    remainder have neither problem: the quotient is counted in ten-thousandths,
    and the remainder decides the last digit. Null where ``units`` is zero.
    """
    shift = F.lit(10_000).cast("decimal(5,0)")
    size = F.abs(amount) * shift
    count = F.abs(F.nullif(units, F.lit(0).cast("bigint"))).cast("decimal(19,0)")
    floor = F.call_function("div", size, count)
    rest = size % count
    steps = floor + F.when(rest * 2 >= count, 1).otherwise(0)
    sign = F.when(F.signum(amount) * F.signum(units) < 0, -1).otherwise(1)
    return ((steps * sign).cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(
        "decimal(22,4)"
    )


def weighted_price(price_volume: Column, volume: Column) -> Column:
    """Volume-weighted average price from the two sums."""
    return exact_ratio(price_volume, volume)
