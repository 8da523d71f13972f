"""Column expressions for raw text cells. Bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRICE_TYPE = "decimal(18,4)"


def text(c: str | Column) -> Column:
    """Cell without surrounding spaces (tabs stay)."""
    return F.trim(c)


def price(c: str | Column) -> Column:
    return _col(c).try_cast(PRICE_TYPE)


def whole(c: str | Column) -> Column:
    """Integer cell; a fraction such as ``3.7`` counts as bad text."""
    return _col(c).try_cast("int")


def cents(c: str | Column) -> Column:
    """Price quoted in hundredths, as a double."""
    return price(c) / F.lit(100.0)


def trade_date(c: str | Column) -> Column:
    return F.try_to_date(F.trim(c), "yyyyMMdd")


def hour_bucket(c: str | Column) -> Column:
    """Two-character hour of a clock text such as ``90501`` or ``9:05:01``.

    ``lpad`` also cuts longer text to six characters, so the hour of an overlong
    clock is its first two digits.
    """
    digits = F.replace(_col(c), F.lit(":"), F.lit(""))
    return F.substring(F.lpad(digits, 6, "0"), 1, 2)


def is_bad(source: str | Column, parsed: Column) -> Column:
    """The cell held something that did not parse."""
    return _col(source).isNotNull() & parsed.isNull()


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
