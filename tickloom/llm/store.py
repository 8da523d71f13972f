"""Written intermediates: they cut the lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import fresh_dir


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the folder that all executors share.

    Spark deletes shuffle files once the driver's garbage collector has found their plan
    unused. With a large heap that may come late, so one collection is asked for here:
    what the write has shuffled is not needed any more.
    """
    spark: SparkSession = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(frame.schema).parquet(path)
    out._written_at = path
    return out


class Scratch:
    """Written intermediates that are deleted at the end of a ``with`` block.

    What leaves the block must not depend on them, so it is written by ``written``.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def write(self, frame: DataFrame, label: str) -> DataFrame:
        out = written(frame, label)
        self._paths.append(out._written_at)
        return out

    def adopt(self, frame: DataFrame) -> DataFrame:
        """Delete a table that ``written`` made along with the others."""
        self._paths.append(frame._written_at)
        return frame

    def __exit__(self, *_) -> None:
        for path in self._paths:
            dropped(self._spark, path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder of files, wherever Spark reaches it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
