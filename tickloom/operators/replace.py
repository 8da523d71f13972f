"""Replacing the rows of some dates in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType

from tickloom.schemas import DATE_KEY


def touched_dates(batch: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Distinct dates of a batch; rows without one touch nothing."""
    return batch.select(key).where(F.col(key).isNotNull()).distinct()


def replace_dates(target: DataFrame, batch: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """The target with all rows of the batch's dates exchanged for the batch.

    Distinct dates are broadcast: four-digit years bound them to 3.7 million values
    of four bytes, whatever the size of the batch. Keys of another type have no such
    bound, and the join is left to Spark.
    """
    touched = touched_dates(batch, key)
    if isinstance(touched.schema[key].dataType, DateType):
        touched = F.broadcast(touched)
    kept = target.join(touched, key, "left_anti").select(*target.columns)
    return kept.unionByName(batch.where(F.col(key).isNotNull()))


def on_days(target: DataFrame, days: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Rows of a table on the days that another frame has, picked when the query runs.

    The days never come to the driver's program: where the table is stored by date and the days
    carry a condition, Spark prunes the table's folders by the broadcast of the days itself.
    Distinct dates are bounded as in ``replace_dates``; days without a date pick nothing.
    """
    picked = touched_dates(days, key)
    if isinstance(picked.schema[key].dataType, DateType):
        picked = F.broadcast(picked)
    return target.join(picked, key, "left_semi").select(*target.columns)
