"""Partitioned table writes that replace only the dates they bring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tickloom.functions.days import calendar_rows
from tickloom.operators.replace import touched_dates
from tickloom.schemas import DATE_KEY, RUN_LOG

# Width of Spark's bitmap aggregate, here one bit per day: about 89 years.
_BITMAP_DAYS = 32768
_EPOCH = dt.date(1970, 1, 1)

# Spark's writer strips white space around values unless told not to.
CSV_OPTIONS = {
    "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def clustered(df: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """Bring the rows of a date together for writing.

    The rebalance hint lets AQE merge small dates into one task and split a date
    that holds much of the data over many, by measured size. A plain
    ``repartition`` by date would give such a date to one task.
    """
    return df.hint("rebalance", key)


def _write(df: DataFrame, path: str, fmt: str, cluster: bool, key: str, **options) -> None:
    rows = clustered(df, key) if cluster else df
    (
        rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**options).partitionBy(key).save(path)
    )


def write_table(df: DataFrame, path: str, cluster: bool = True, key: str = DATE_KEY) -> None:
    """Parquet by date; dates not in ``df`` stay as they are.

    Pass ``cluster=False`` when each input split already holds few dates, as files
    of the raw zone do: that saves shuffling the whole batch.
    """
    _write(df, path, "parquet", cluster, key)


def write_csv(df: DataFrame, path: str, cluster: bool = True, key: str = DATE_KEY) -> None:
    """Header text by date, same replacement. Normally one file per date."""
    _write(df, path, "csv", cluster, key, **CSV_OPTIONS)


class WriteWatch:
    """Facts about a batch gathered while it is written, without another pass.

    ``watched`` has the same rows; once an action on it is done, ``dates`` and
    ``counts`` are known. The dates come as a bitmap with one bit per day. When Spark
    repeats a stage, counts may include its rows twice; dates, and whether a count is
    zero, do not change.
    """

    def __init__(self, df: DataFrame, key: str = DATE_KEY, **counts: Column):
        self._seen = Observation()
        day = F.unix_date(key)
        bit = F.bitmap_bit_position((F.pmod(day, F.lit(_BITMAP_DAYS)) + 1).cast("bigint"))
        self.watched = df.observe(
            self._seen,
            F.min(day).alias("lo"), F.max(day).alias("hi"),
            F.bitmap_construct_agg(bit).alias("bits"),
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(c).alias(name) for name, c in counts.items()],
        )

    @property
    def counts(self) -> dict[str, int]:
        return {k: v for k, v in self._seen.get.items() if k not in ("lo", "hi", "bits")}

    def dates(self) -> list[dt.date] | None:
        """Touched dates; None if they span more days than the bitmap holds."""
        seen = self._seen.get
        if seen["lo"] is None:
            return []
        if seen["hi"] - seen["lo"] >= _BITMAP_DAYS:
            return None
        bits = seen["bits"]
        days = range(seen["lo"], seen["hi"] + 1)
        hit = [d for d in days if bits[d % _BITMAP_DAYS // 8] >> (d % 8) & 1]
        return [_EPOCH + dt.timedelta(days=d) for d in hit]


def batch_dates(batch: DataFrame, watch: WriteWatch, key: str = DATE_KEY) -> list[dt.date]:
    """Touched dates of a written batch, by a second pass only if the bitmap is too short."""
    dates = watch.dates()
    if dates is None:
        dates = [row[0] for row in calendar_rows(touched_dates(batch, key))]
    return sorted(dates)


def ensure_run_log(spark: SparkSession, database: str, table: str, path: str) -> str:
    """Create the run log's database and table if absent; returns the table's name."""
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({RUN_LOG.toDDL()}) USING parquet LOCATION '{path}'"
    )
    return name


def append_runs(entries: DataFrame, path: str) -> None:
    """Add state changes to the log. Entries are never updated; the latest one counts."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG]
    entries.select(*columns).write.mode("append").parquet(path)
