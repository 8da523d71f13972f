"""File listings as DataFrames, and opening listed files inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import LISTING

# Schemes Spark and Arrow spell differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def list_files(
    spark: SparkSession, paths: str | list[str], name_glob: str | None = None
) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``paths``.

    The column selection keeps file contents unread. A root that does not exist
    yet holds no files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    try:
        return reader.load(paths).select(*LISTING.fieldNames())
    except Exception as error:  # the analysis error class differs between Spark releases
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LISTING)


def few_tasks(listing: DataFrame) -> DataFrame:
    """Pack a listing into a few tasks per core.

    The listing scan plans about one task per large file, far more than reading
    the first lines of each file needs. Coalescing moves no data.
    """
    return listing.coalesce(4 * listing.sparkSession.sparkContext.defaultParallelism)


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a URI as Spark reports it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        rest = "//" + "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def per_row(
    make_batches: Callable[[dict], Iterable[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` body that turns each input row into any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from make_batches(row)

    return run
