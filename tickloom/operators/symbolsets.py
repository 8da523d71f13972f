"""Distinct symbols of any date range from sets kept per date.

A dictionary gives each symbol a number for good. A date's symbols are the set bits of its
bitmaps, and a sketch next to them: both add up over dates, bitmaps exactly, sketches within
their error. So a count over years reads a few kilobytes a date and no summary row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.schemas import DATE_KEY
from tickloom.sinks.tables import write_table
from tickloom.sources.tables import read_dates, read_or_empty

#: Parts of the dictionary that are numbered side by side.
SHARDS = 64
#: Two to this many registers in a sketch: a standard error of 1.6 percent.
SKETCH_BITS = 12

_DICTIONARY = "Symbol string, number long"
_SETS = f"{DATE_KEY} date, bucket long, bitmap binary"
_SKETCHES = f"{DATE_KEY} date, sketch binary"


def extend_dictionary(symbols: DataFrame, path: str) -> DataFrame:
    """Number the symbols that the dictionary does not know, and return all of it.

    Numbers are dense within each shard and never change. One run at a time may extend a dictionary.
    """
    spark = symbols.sparkSession
    known = read_or_empty(spark, path, _DICTIONARY)
    new = symbols.where(F.col("Symbol").isNotNull()).select("Symbol").distinct().join(known, "Symbol", "left_anti")
    ends = known.groupBy(F.col("number") % SHARDS).agg(F.max("number").alias("end")).select(
        (F.col("end") % SHARDS).alias("shard"), "end"
    )
    rank = F.row_number().over(Window.partitionBy("shard").orderBy("Symbol")) - 1
    numbered = (
        new.withColumn("shard", F.pmod(F.xxhash64("Symbol"), F.lit(SHARDS)))
        .join(ends, "shard", "left")
        .select("Symbol", (F.coalesce(F.col("end") + SHARDS, F.col("shard")) + rank * SHARDS).cast("long").alias("number"))
    )
    numbered.write.mode("append").parquet(path)
    return read_or_empty(spark, path, _DICTIONARY)


def refresh_sets(summary: DataFrame, root: str) -> None:
    """Replace the sets and sketches of the dates of these summary rows, which must be whole dates."""
    pairs = summary.select(DATE_KEY, "Symbol").where(F.col("Symbol").isNotNull()).distinct()
    dictionary = extend_dictionary(pairs, f"{root}/dictionary")
    place = F.col("number") + 1
    sets = pairs.join(dictionary, "Symbol").groupBy(DATE_KEY, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )
    write_table(sets, f"{root}/sets")
    write_table(pairs.groupBy(DATE_KEY).agg(F.hll_sketch_agg("Symbol", SKETCH_BITS).alias("sketch")), f"{root}/sketches")


def distinct_symbols(spark: SparkSession, root: str, dates: list[dt.date]) -> DataFrame:
    """(symbols, estimate): how many different symbols some dates have together."""
    sets = read_dates(spark, f"{root}/sets", dates, _SETS)
    joined = sets.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    sketches = read_dates(spark, f"{root}/sketches", dates, _SKETCHES)
    union = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    exact = joined.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("symbols"))
    return exact.withColumn("estimate", F.coalesce(union.scalar(), F.lit(0)))
