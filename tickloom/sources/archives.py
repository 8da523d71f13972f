"""Ticks inside zip archives.

Tasks open archives where they lie and stream their members, so neither the
driver nor a temporary folder sees the data and no archive has to fit in memory.
A member is the unit of work: deflate streams cannot be split.
"""

from __future__ import annotations

import zipfile
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.schemas import RAW_TICK_COLUMNS, ZIPPED_TICKS
from tickloom.session import fresh_dir
from tickloom.sources.delimited import Layout, header_rows
from tickloom.sources.files import locate, per_row
from tickloom.sources.textlines import CHUNK, after_first_line, first_line, text_blocks

# Blocks of a member that stay together when it is spread, about 32 MB.
BLOCKS_PER_PART = 32

# Unpacked size from which on a member's blocks are spread over tasks. Smaller ones are
# parsed by the task that unpacks them.
SPREAD_BYTES = 256 << 20

_CATALOG = "path string, slot int, member string, size long, header string, error string"
_BLOCKS = "path string, member string, part int, block string"
_CHECKED = "path string, member string, part int, block string, lines long, error string"


@dataclass(frozen=True)
class ArchiveRead:
    """Rows of the readable archives, and one row per archive or member left out."""

    rows: DataFrame
    errors: DataFrame


def archive_members(
    listing: DataFrame, suffix: str = ".csv", verify: bool = True
) -> DataFrame:
    """One row per member ending in ``suffix``: its place, size, header and any defect.

    Every member is unpacked once to test its checksum, so that a damaged one is
    known before any of its rows are used. One bad member, or one without the
    needed columns, rules out its archive: a day is loaded whole or reported. Without
    ``verify`` members are unpacked only once, and a damaged one fails the load.
    """

    def inspect(row: dict):
        found, error = [], None
        try:
            system, path = locate(row["path"])
            with system.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
                for slot, info in enumerate(archive.infolist()):
                    if not info.filename.endswith(suffix):
                        continue
                    with archive.open(info) as stream:
                        header = first_line(stream)
                        while verify and stream.read(CHUNK):
                            pass
                    if header and (missing := Layout(header, ",").lacks(RAW_TICK_COLUMNS)):
                        raise ValueError(f"{info.filename} lacks {missing}")
                    found.append((slot, info.filename, info.file_size, header))
        except Exception as problem:  # any damage is reported as a row
            found, error = [], f"{type(problem).__name__}: {problem}"
        if not found:
            found, error = [(None, None, None, None)], error or f"no member ending in {suffix}"
        slots, members, sizes, headers = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["path"]] * len(found), pa.string()),
                pa.array(slots, pa.int32()),
                pa.array(members, pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(headers, pa.string()),
                pa.array([error] * len(found), pa.string()),
            ],
            names=["path", "slot", "member", "size", "header", "error"],
        )

    return listing.select("path").mapInArrow(per_row(inspect), _CATALOG)


def member_blocks(members: DataFrame) -> DataFrame:
    """``path, member, part, block``: the lines after the header, a megabyte a block.

    Tasks only unpack and cut at line ends. Splitting blocks into lines is left to
    Spark: a row per block costs far less to hand over, and to shuffle, than a row
    per line.
    """

    def unpack(row: dict):
        system, path = locate(row["path"])
        with system.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
            # By place: two members of an archive may have the same name.
            with archive.open(archive.infolist()[row["slot"]]) as stream:
                for at, block in enumerate(after_first_line(text_blocks(stream))):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["path"]]),
                            pa.array([row["member"]]),
                            pa.array([at // BLOCKS_PER_PART], pa.int32()),
                            pa.array([block]),
                        ],
                        names=["path", "member", "part", "block"],
                    )

    return members.select("path", "slot", "member").mapInArrow(per_row(unpack), _BLOCKS)


def checked_blocks(members: DataFrame) -> DataFrame:
    """``path, member, part, block, lines, error``: blocks, and a row about each whole member.

    The row after a member's blocks has the number of its lines, blank ones left out, as
    counted by the task that read them. If the member cannot be read to its end, checksum
    included, the row has the error instead.
    """

    def unpack(row: dict):
        def batch(part, block, lines, error):
            values = [row["path"], row["member"], part, block, lines, error]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)],
                names=["path", "member", "part", "block", "lines", "error"],
            )

        lines = 0
        try:
            system, path = locate(row["path"])
            with system.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
                with archive.open(archive.infolist()[row["slot"]]) as stream:
                    for at, block in enumerate(after_first_line(text_blocks(stream))):
                        lines += sum(bool(line.strip(" \t")) for line in block.split("\n"))
                        yield batch(at // BLOCKS_PER_PART, block, None, None)
        except Exception as problem:  # any damage is reported as a row
            yield batch(None, None, None, f"{type(problem).__name__}: {problem}")
        else:
            yield batch(None, None, lines, None)

    return members.select("path", "slot", "member").mapInArrow(per_row(unpack), _CHECKED)


def checked_lines(blocks: DataFrame, layout: Layout) -> DataFrame:
    """The lines of checked blocks as raw ticks (``is_line``), next to the rows about members."""
    whole = F.when(F.col("block").isNotNull(), F.split("block", "\n")).otherwise(F.array(F.lit(None).cast("string")))
    lines = blocks.select("path", "member", "lines", "error", F.explode(whole).alias("line"))
    lines = lines.where(F.col("line").isNull() | (F.btrim("line", F.lit(" \t")) != ""))
    record = F.from_csv("line", layout.schema().toDDL(), {"sep": layout.sep})
    return lines.select(
        "path", "member", "lines", "error", F.col("line").isNotNull().alias("is_line"), F.inline(F.array(record))
    )


def parsed_blocks(blocks: DataFrame, layout: Layout) -> DataFrame:
    """Columns of the lines of each block, named as in the layout.

    ``inline`` makes them columns of their own: a filter on one is then not pushed
    down into a second parse of the line.
    """
    lines = blocks.select("path", "member", F.explode(F.split("block", "\n")).alias("line"))
    lines = lines.where(F.btrim("line", F.lit(" \t")) != "")
    record = F.from_csv("line", layout.schema().toDDL(), {"sep": layout.sep})
    return lines.select("path", "member", F.inline(F.array(record)))


def _catalog(listing: DataFrame, verify: bool) -> DataFrame:
    """The members of the listed archives, written, so that all that follows rests on one state of them."""
    path = fresh_dir(listing.sparkSession, "archive-catalog")
    archive_members(listing, verify=verify).write.parquet(path)
    return listing.sparkSession.read.parquet(path)


def read_checked_ticks(listing: DataFrame, spread_bytes: int = SPREAD_BYTES) -> ArchiveRead:
    """Every line of all listed archives as raw ticks, read once, with rows about each member.

    ``rows`` has the raw columns, ``path``, ``member``, ``is_line``, and in the rows about a
    member ``lines`` or ``error``; lines of a member that turned out to be damaged are among them.
    ``errors`` has the archives whose directory, first line or columns could not be used.
    """
    spark = listing.sparkSession
    catalog = _catalog(listing, verify=False)
    errors = catalog.where("error is not null").select("path", "error").distinct()
    good = catalog.where("error is null and header is not null")
    # A set number of tasks: merged by size, the short rows of the catalog would all be one task's.
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), good.count()))

    def rows(header: str) -> DataFrame:
        members = good.where(F.col("header") == header)
        small = checked_blocks(members.where(F.col("size") < spread_bytes).repartition(tasks))
        large = checked_blocks(members.where(F.col("size") >= spread_bytes).repartition(tasks))
        blocks = small.unionByName(large.hint("rebalance", "path", "member", "part"))
        return checked_lines(blocks, Layout(header, ",")).select(
            *RAW_TICK_COLUMNS, "path", "member", "is_line", "lines", "error"
        )

    headers = header_rows(good)
    if not headers:
        empty = f"{ZIPPED_TICKS.toDDL()}, is_line boolean, lines long, error string"
        return ArchiveRead(spark.createDataFrame([], empty), errors)
    return ArchiveRead(reduce(DataFrame.unionByName, map(rows, headers)), errors)


def read_zipped_ticks(
    listing: DataFrame, verify: bool = True, together: str | None = None
) -> ArchiveRead:
    """Raw ticks of all listed archives, with their ``path`` and ``member``.

    The catalog of members is written before it is used: rows, errors and later
    retries all rest on the same state of the archives. Archives that share the column
    ``together`` of the listing with a damaged one are left out with it. Unpacking a
    member is bound to one task; parsing its lines costs several times more, so blocks
    are spread, neighbours together, and AQE sizes the tasks.
    """
    spark = listing.sparkSession
    catalog_path = fresh_dir(spark, "archive-catalog")
    key = F.col(together) if together else F.col("path")
    keyed = listing.select("path", key.cast("string").alias("unit"))
    archive_members(listing, verify=verify).join(keyed, "path").write.parquet(catalog_path)
    catalog = spark.read.parquet(catalog_path)
    errors = catalog.where("error is not null").select("path", "error").distinct()
    damaged = catalog.where("error is not null").select("unit").distinct()
    good = catalog.where("error is null and header is not null").join(damaged, "unit", "left_anti")
    headers = header_rows(good)

    def rows(header: str) -> DataFrame:
        # One task per member, as far as there are tasks.
        members = good.where(F.col("header") == header).repartition("path", "slot")
        blocks = member_blocks(members).hint("rebalance", "path", "member", "part")
        return parsed_blocks(blocks, Layout(header, ",")).select(*RAW_TICK_COLUMNS, "path", "member")

    if not headers:
        return ArchiveRead(spark.createDataFrame([], ZIPPED_TICKS), errors)
    return ArchiveRead(reduce(DataFrame.unionByName, map(rows, headers)), errors)
