"""Delimited text with a header line, bound by column name.

Spark applies one header to all files of a read, by position. The exchange does
not promise a column order, so files are grouped by their header line and every
group is read with its own schema. There is normally one group, hence one scan.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import RAW_CANCEL_COLUMNS, RAW_TICK_COLUMNS
from tickloom.sources.files import few_tasks, list_files, locate, per_row
from tickloom.sources.textlines import first_line

@dataclass(frozen=True)
class Layout:
    """One header line and the columns it names."""

    header: str
    sep: str

    def names(self) -> list[str]:
        return [cell.strip() for cell in next(csv.reader([self.header], delimiter=self.sep))]

    def schema(self) -> T.StructType:
        """All-text schema; repeated or blank names get their position added."""
        seen: set[str] = set()
        fields = []
        for at, name in enumerate(self.names()):
            if not name or name.lower() in seen:
                name = f"{name}_{at}"
            seen.add(name.lower())
            fields.append(T.StructField(name, T.StringType(), True))
        return T.StructType(fields)

    def lacks(self, required: list[str]) -> list[str]:
        present = {name.lower() for name in self.names()}
        return [name for name in required if name.lower() not in present]


def file_headers(listing: DataFrame) -> DataFrame:
    """``path, header`` for each listed file; only the start of a file is read."""

    def probe(row: dict):
        system, path = locate(row["path"])
        with system.open_input_file(path) as stream:
            header = first_line(stream)
        yield pa.RecordBatch.from_pydict({"path": [row["path"]], "header": [header]})

    return few_tasks(listing.select("path")).mapInArrow(
        per_row(probe), "path string, header string"
    )


def layouts(headers: DataFrame, sep: str, required: list[str]) -> list[Layout]:
    """Distinct layouts of a ``header`` column, checked to hold all required names."""
    return [checked(Layout(line, sep), required) for line in header_rows(headers)]


def header_rows(frame: DataFrame) -> list[str]:
    """Distinct header lines, sorted. Each becomes a scan of its own in the plan."""
    lines = frame.where("header is not null").select("header").distinct()
    return sorted(row.header for row in lines.collect())


def checked(layout: Layout, required: list[str]) -> Layout:
    if missing := layout.lacks(required):
        raise ValueError(f"header {layout.header!r} lacks {missing}")
    return layout


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    required: list[str],
    sep: str = ",",
    name_glob: str | None = None,
    origin: bool = False,
) -> DataFrame:
    """The required columns as text, over all files, whatever their column order.

    ``origin`` adds the file's ``path`` and a null ``member``.
    """
    listing = list_files(spark, paths, name_glob)
    headers = file_headers(listing)
    found = layouts(headers, sep, required)
    more = ["path", "member"] if origin else []
    if not found:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(name, T.StringType(), True) for name in [*required, *more]]))

    def scan(layout: Layout, where: str | list[str]) -> DataFrame:
        reader = spark.read.schema(layout.schema()).option("header", True).option("sep", sep)
        reader = reader.option("recursiveFileLookup", "true")
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        place = [F.col("_metadata.file_path").alias("path"), F.lit(None).cast("string").alias("member")]
        return reader.csv(where).select(*required, *(place if origin else []))

    if len(found) == 1:
        return scan(found[0], paths)
    # Several layouts: Spark needs the file names of each group. That is the file
    # index the driver holds for any scan, not data.
    by_header: dict[str, list[str]] = {layout.header: [] for layout in found}
    for row in headers.where("header is not null").toLocalIterator():
        by_header[row.header].append(row.path)
    return reduce(
        DataFrame.unionByName, [scan(layout, by_header[layout.header]) for layout in found]
    )


def read_ticks(
    spark: SparkSession, paths: str | list[str], name_glob: str = "*.csv", origin: bool = False
) -> DataFrame:
    """Raw ticks from unpacked comma-separated files."""
    return read_delimited(spark, paths, RAW_TICK_COLUMNS, ",", name_glob, origin)


def read_cancels(
    spark: SparkSession, paths: str | list[str], name_glob: str = "*.txt", origin: bool = False
) -> DataFrame:
    """Raw cancellations from tab-separated files."""
    return read_delimited(spark, paths, RAW_CANCEL_COLUMNS, "\t", name_glob, origin)


def drop_repeated_headers(raw: DataFrame, key: str) -> DataFrame:
    """Drop header lines inside the data, and rows without a key.

    A null key compares as unknown and is dropped too: an empty cell reads as null.
    """
    return raw.where(F.col(key) != key)
