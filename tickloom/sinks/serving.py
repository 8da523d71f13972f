"""The serving table over JDBC: append, refresh, and replacement of dates.

Executors connect to the database, so the driver class must be on their class path
and the database must be reachable from them. ``numPartitions`` bounds the number
of connections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from tickloom.operators.replace import replace_dates
from tickloom.schemas import DATE_KEY
from tickloom.session import fresh_dir
from tickloom.sources.tables import read_whole_serving

CONNECTIONS = 8
BATCH_ROWS = 10_000


def _writer(df: DataFrame, url: str, table: str, options: dict[str, str]) -> DataFrameWriter:
    settings = {
        "url": url, "dbtable": table,
        "batchsize": str(BATCH_ROWS), "numPartitions": str(CONNECTIONS), **options,
    }
    return df.write.format("jdbc").options(**settings)


def append_serving(df: DataFrame, url: str, table: str, **options: str) -> None:
    _writer(df, url, table, options).mode("append").save()


def refresh_serving(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Exchange all rows; truncating keeps the table's types, indexes and grants."""
    _writer(df, url, table, options).mode("overwrite").option("truncate", True).save()


def staged_replacement(target: DataFrame, batch: DataFrame, key: str = DATE_KEY) -> DataFrame:
    """The replaced table, written out and read back.

    Nothing that follows depends on the target any more, so it can be overwritten,
    and a lost executor cannot make Spark re-read a half-replaced target.
    """
    spark = target.sparkSession
    staged = fresh_dir(spark, "serving-replace")
    replace_dates(target, batch, key).write.parquet(staged)
    return spark.read.schema(target.schema).parquet(staged)


def serving_exists(spark: SparkSession, url: str, table: str, **options: str) -> bool:
    """Whether the database knows the table, by its information schema."""
    schema, _, name = table.replace('"', "").replace("'", "''").rpartition(".")
    where = f"lower(table_name) = lower('{name}')" + (f" AND lower(table_schema) = lower('{schema}')" if schema else "")
    found = spark.read.format("jdbc").options(
        url=url, query=f"SELECT count(*) AS n FROM information_schema.tables WHERE {where}", **options
    ).load()
    return found.first().n > 0


def replace_serving(
    batch: DataFrame, url: str, table: str, key: str = DATE_KEY, **options: str
) -> None:
    """Exchange the rows of the batch's dates. Running it twice changes nothing more.

    The first time the batch makes the table. While the table is exchanged readers may see
    a part of it; a failure then leaves the whole of it in the staged copy, which is
    written before and named in the error.
    """
    if not serving_exists(batch.sparkSession, url, table, **options):
        append_serving(batch.where(F.col(key).isNotNull()), url, table, **options)
        return
    target = read_whole_serving(batch.sparkSession, url, table, **options)
    staged = staged_replacement(target, batch, key)
    try:
        refresh_serving(staged, url, table, **options)
    except Exception as error:
        raise RuntimeError(f"{table} may be incomplete; all its rows are in {staged.inputFiles()[:1]}") from error
