"""Published tables: summary as text or Parquet, and the serving table over JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.schemas import DATE_KEY, SUMMARY

# Rows a connection fetches at a time; some drivers fetch all of them by default.
FETCH_ROWS = 10_000


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """A Parquet table with the given columns; empty while it does not exist."""
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except Exception as error:  # the analysis error class differs between Spark releases
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_dates(
    spark: SparkSession, path: str, dates: list[dt.date], schema: StructType | None = None
) -> DataFrame:
    """Rows of some dates of a table; only the folders of those dates are listed.

    With a schema, dates without a folder have no rows.
    """
    if schema is None:
        reader = spark.read.option("basePath", path)
        return reader.parquet(*[f"{path}/{DATE_KEY}={day.isoformat()}" for day in dates])
    chosen = ",".join(sorted({day.isoformat() for day in dates}))
    return read_or_empty(spark, f"{path}/{DATE_KEY}={{{chosen}}}", schema, basePath=path)


def retype_summary(text: DataFrame) -> DataFrame:
    """Summary read as text, with the types the roll-up computes."""
    return text.select(
        *[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in SUMMARY]
    )


def read_summary_csv(spark: SparkSession, root: str) -> DataFrame:
    """Summary written as header text under ``TradeDateParsed=<date>/`` folders.

    All columns are declared as text: hours keep their leading zero. The date
    column comes from the folder names.
    """
    text = ", ".join(f"{name} string" for name in SUMMARY.fieldNames() if name != DATE_KEY)
    frame = (
        spark.read.schema(f"{text}, {DATE_KEY} date")
        .option("header", True).option("enforceSchema", False).csv(root)
    )
    return retype_summary(frame)


def read_serving(
    spark: SparkSession,
    url: str,
    table: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    slices: int = 8,
    **options: str,
) -> DataFrame:
    """Serving table over JDBC; with date bounds, read in parallel slices by date.

    Filters, column selection, aggregates and limits on the result run in the
    database where Spark can push them.
    """
    settings = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), **options}
    reader = spark.read.format("jdbc").options(**settings)
    if first and last:
        reader = reader.options(
            partitionColumn=DATE_KEY, lowerBound=str(first), upperBound=str(last),
            numPartitions=str(slices),
        )
    return reader.load()


def read_whole_serving(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """All rows of the serving table, in parallel slices over its own date range."""
    span = read_serving(spark, url, table, **options).agg(
        F.min(DATE_KEY).alias("first"), F.max(DATE_KEY).alias("last")
    ).first()
    return read_serving(spark, url, table, span.first, span.last, **options)
