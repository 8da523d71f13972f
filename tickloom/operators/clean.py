"""Raw text rows to typed ticks and cancellations, and the rows that did not parse.

Cleaning never fails on bad text: the cell becomes null, as the published tables
have always held it, and the row is listed by ``reject_*``. Rows without a usable
trade date have no partition to go to; ``dated`` keeps them out of the tables.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import cells
from tickloom.schemas import CANCELS, DATE_KEY, RAW_TICK_COLUMNS, TICKS
from tickloom.sources.delimited import drop_repeated_headers

# Published name of each raw text column.
TICK_TEXT = {
    "Symbol": "Comm", "ContractType": "Contract_Type", "MonthCode": "Mth_Code",
    "DeliveryYear": "Year", "StrikePrice": "Strike", "TradeTime": "Log_Time",
    "MessageCode": "Msg_Code",
}
CANCEL_TEXT = {
    "Symbol": "Commodity", "ContractType": "Contract_Type", "DeliveryMonth": "Delivery_Month",
    "DeliveryYear": "Delivery_Year", "StrikePrice": "Strike_Price",
    "TradeDate": "Business_Date", "CancelTime": "Match_Time",
    "PriceIndicator": "Price_Indicator", "MessageCode": "Message_Code",
    "AmendCode": "Amend_Code",
}


def clean_ticks(raw: DataFrame, *extra: Column) -> DataFrame:
    """Typed ticks; ``extra`` columns over the raw names may be added."""
    rows = drop_repeated_headers(raw, "Comm")
    return _typed(rows, _tick_columns(), TICKS.fieldNames(), extra)


def _tick_columns() -> dict[str, Column]:
    day = cells.trade_date("Trade_Date")
    return {
        **{name: cells.text(source) for name, source in TICK_TEXT.items()},
        DATE_KEY: day,
        "TradePrice": cells.price("Price"),
        "TradeVolume": cells.whole("Volume"),
        "year": F.year(day),
        "month": F.month(day),
    }


def clean_cancels(raw: DataFrame, *extra: Column) -> DataFrame:
    """Typed cancellations; prices come in hundredths."""
    day = cells.trade_date("Business_Date")
    columns = {
        **{name: cells.text(source) for name, source in CANCEL_TEXT.items()},
        DATE_KEY: day,
        "Price": cells.cents("Price"),
        "Volume": cells.whole("Volume"),
        "year": F.year(day),
        "month": F.month(day),
    }
    rows = drop_repeated_headers(raw, "Commodity")
    return _typed(rows, columns, CANCELS.fieldNames(), extra)


def _typed(
    raw: DataFrame, columns: dict[str, Column], order: list[str], extra: tuple[Column, ...]
) -> DataFrame:
    # One projection over the raw names: a published name such as ``year`` may
    # equal a raw one, and must not replace it half-way.
    return raw.select(*[columns[name].alias(name) for name in order], *extra)


def dated(cleaned: DataFrame) -> DataFrame:
    """Rows that belong to a date partition."""
    return cleaned.where(F.col(DATE_KEY).isNotNull())


# What becomes of a line; each has one of these outcomes.
CLEAN, REPAIRED, STRAY, UNDATED, KEYLESS, HEADER = "clean", "repaired", "stray", "undated", "keyless", "header"
OUTCOMES = [CLEAN, REPAIRED, STRAY, UNDATED, KEYLESS, HEADER]
#: Outcomes that go to the table, and those that are listed as rejects.
KEPT, REJECTED = [CLEAN, REPAIRED], [REPAIRED, STRAY, UNDATED]


def judged_ticks(raw: DataFrame) -> DataFrame:
    """Every raw line with its ``outcome``, typed columns and, if it has a defect, its raw cells as ``reject``.

    A repeated header and a line without a symbol are dropped by a load, a line without a usable
    date or of another date than its file's (``file_day``) is rejected, one with bad cells is kept
    with nulls and listed as a reject too. Columns of ``raw`` beyond the raw cells stay.
    """
    day = cells.trade_date("Trade_Date")
    checks = tick_checks(of_file=True)
    names = [F.when(bad, F.lit(name)) for name, bad in checks.items()]
    other = F.coalesce(day != F.col("file_day"), F.lit(False))
    outcome = (
        F.when(F.col("Comm").isNull(), KEYLESS).when(F.col("Comm") == "Comm", HEADER).when(day.isNull(), UNDATED)
        .when(other, STRAY).when(flawed(checks), REPAIRED).otherwise(CLEAN)
    )
    reject = F.struct(*RAW_TICK_COLUMNS, F.array_compact(F.array(*names)).alias("reasons"))
    columns = _tick_columns()
    more = [c for c in raw.columns if c not in RAW_TICK_COLUMNS]
    return raw.select(
        *[columns[name].alias(name) for name in TICKS.fieldNames()], outcome.alias("outcome"),
        F.when(outcome.isin(REJECTED), reject).alias("reject"), *more,
    )


def tick_checks(of_file: bool = False) -> dict[str, Column]:
    """Per defect of a raw tick: whether the row has it.

    ``of_file`` adds the defect of another date than ``file_day``, the day of the file.
    """
    return _checks("Trade_Date", {"Price": cells.price, "Volume": cells.whole}, of_file)


def cancel_checks(of_file: bool = False) -> dict[str, Column]:
    return _checks("Business_Date", {"Price": cells.price, "Volume": cells.whole}, of_file)


def _checks(
    date_cell: str, parsers: dict[str, Callable[[str], Column]], of_file: bool
) -> dict[str, Column]:
    day = cells.trade_date(date_cell)
    bad = {name: cells.is_bad(name, parse(name)) for name, parse in parsers.items()}
    found = {date_cell: cells.is_bad(date_cell, day), **bad, "no trade date": day.isNull()}
    if of_file:
        found["other date than the file's"] = F.coalesce(day != F.col("file_day"), F.lit(False))
    return found


def flawed(checks: dict[str, Column]) -> Column:
    """Any of the defects; cheaper than listing them."""
    return reduce(operator.or_, checks.values())


def reject_ticks(raw: DataFrame, of_file: bool = False) -> DataFrame:
    """Raw rows with a defect, and their ``reasons``."""
    return _rejects(drop_repeated_headers(raw, "Comm"), tick_checks(of_file))


def reject_cancels(raw: DataFrame, of_file: bool = False) -> DataFrame:
    return _rejects(drop_repeated_headers(raw, "Commodity"), cancel_checks(of_file))


def _rejects(raw: DataFrame, checks: dict[str, Column]) -> DataFrame:
    names = [F.when(bad, F.lit(name)) for name, bad in checks.items()]
    return raw.where(flawed(checks)).withColumn("reasons", F.array_compact(F.array(*names)))
