"""Incremental loads: nothing twice, corrections replace, hours close."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom import samples
from tickloom.operators.rollup import tick_summary
from tickloom.plans.daily import Lake
from tickloom.schemas import RAW_TICK_COLUMNS, SUMMARY
from tickloom.sources.tables import read_or_empty
from tickloom.streaming import loads, partials

SF = "/root/testdata/sf0.001"


def test_restart_loads_nothing_again(spark, folder):
    raw = samples.raw_ticks(spark, SF)
    samples.write_delimited(raw, f"{folder}/in/first")

    def load():
        stream = loads.tick_stream(spark, f"{folder}/in", per_batch=1)
        query = loads.load_new_files(stream, f"{folder}/out", f"{folder}/rejects", f"{folder}/check")
        query.awaitTermination()
        return spark.read.parquet(f"{folder}/out").count()

    total = raw.count()
    assert load() == total
    assert load() == total
    samples.write_delimited(raw.limit(7), f"{folder}/in/second")
    assert load() == total + 7


def test_other_header_fails_rather_than_shifts(spark, folder):
    names = list(reversed(RAW_TICK_COLUMNS))
    folder.put("in/a.csv", ",".join(names) + "\n3,1.5,20240101,T,90501,0,2024,F,F,NK\n")
    query = loads.load_new_files(
        loads.tick_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/rejects", f"{folder}/check"
    )
    with pytest.raises(Exception, match="header"):
        query.awaitTermination()


def test_correction_replaces_a_day(spark, folder):
    raw = samples.raw_ticks(spark, SF)
    day = raw.where("Trade_Date = '20240103'")
    lake = Lake(f"{folder}/lake")

    def deliver(frame, name):
        samples.write_delimited(frame.coalesce(1), f"{folder}/in/{name}")
        loads.replace_days(
            loads.tick_stream(spark, f"{folder}/in"), lake, f"{folder}/check"
        ).awaitTermination()

    deliver(raw, "all")
    summary = spark.read.parquet(lake.summary).select(*SUMMARY.fieldNames())
    expected = tick_summary(samples.ticks(spark, SF))
    assert sorted(map(str, summary.collect())) == sorted(map(str, expected.collect()))
    deliver(day.limit(2), "fix")
    ticks = spark.read.parquet(lake.ticks)
    assert ticks.where("TradeDateParsed = '2024-01-03'").count() == 2
    assert ticks.count() == raw.count() - day.count() + 2
    recounted = spark.read.parquet(lake.summary).groupBy("TradeDateParsed").agg(
        F.sum("GroupTradeCount").alias("n")
    )
    assert {r.TradeDateParsed: r.n for r in recounted.collect()}[dt.date(2024, 1, 3)] == 2


def test_late_ticks_and_open_hours(spark, folder):
    def put(name, *ticks):
        frame = spark.createDataFrame(
            [("NK", "T", dt.date(2026, 5, 29), clock, None, 1) for clock in ticks],
            "Symbol string, MessageCode string, TradeDateParsed date, TradeTime string,"
            " TradePrice decimal(18,4), TradeVolume int",
        )
        frame.coalesce(1).write.parquet(f"{folder}/in/{name}")
        reader = spark.readStream.schema(frame.schema).option("recursiveFileLookup", True)
        stream = reader.parquet(f"{folder}/in")
        query = (
            loads.hourly_summary(stream).writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/check").trigger(availableNow=True)
            .start(f"{folder}/out")
        )
        query.awaitTermination()
        found = spark.read.schema(SUMMARY).parquet(f"{folder}/out").collect()
        return sorted((r.Hour, r.GroupTradeCount) for r in found)

    assert put("a", "90000", "95959", "100500") == []
    assert put("b", "95958", "101500") == [("09", 3)]
    assert put("c", "90001", "113000") == [("09", 3), ("10", 2)]


def test_late_ticks_correct_their_hours(spark, folder):
    """Any number of batches, folds, a repeated batch and a covered rest give the summary of all ticks."""
    ticks = samples.ticks(spark, SF).where("TradeDateParsed BETWEEN '2024-01-03' AND '2024-01-04'").cache()
    summary, sums = f"{folder}/summary", f"{folder}/partials"

    def load():
        reader = spark.readStream.schema(ticks.schema).option("recursiveFileLookup", True)
        stream = reader.option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        partials.correct_hours(stream, sums, summary, f"{folder}/check", least=3).awaitTermination()
        return sorted(map(str, spark.read.parquet(summary).select(*SUMMARY.fieldNames()).collect()))

    parts = [ticks.where(f"TradeVolume % 5 = {n}") for n in range(5)]
    for n, part in enumerate(parts[:4]):
        part.coalesce(1).write.parquet(f"{folder}/in/{n}")
    first = parts[0]
    for part in parts[1:4]:
        first = first.unionByName(part)
    assert load() == sorted(map(str, tick_summary(first).collect()))
    day = dt.date(2024, 1, 3)
    spans = partials._live_spans(spark, sums, [day])
    assert 1 <= spans.count() < 4 and spans.where("last_batch > first_batch").count() == 1
    # What a fold covers counts no more, though its files may still be there.
    covered = tick_summary(parts[0]).select(*SUMMARY.fieldNames(), F.lit(0).alias("first_batch"), F.lit(0).alias("last_batch"))
    partials._store(covered, sums)
    for n, part in enumerate(parts[4:]):
        part.coalesce(1).write.parquet(f"{folder}/in/late{n}")
    assert load() == load() == sorted(map(str, tick_summary(ticks).collect()))


def test_archives_arrive_and_a_broken_one_does_not_stop_the_rest(spark, folder):
    def put(name, *lines):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as out:
            out.writestr("t.csv", "\n".join([",".join(RAW_TICK_COLUMNS), *lines]))
        folder.put(f"raw/{name}", buffer.getvalue())

    def line(day, volume):
        return f"NK,F,M,2026,0,90501,T,{day},1.5,{volume}"

    lake = Lake(f"{folder}/lake")

    def load():
        stream = loads.archive_stream(spark, f"{folder}/raw")
        loads.replace_days_from_archives(stream, lake, f"{folder}/check").awaitTermination()
        rows = spark.read.parquet(lake.summary).collect()
        return {(str(r.TradeDateParsed), r.GroupVolume) for r in rows}

    put("20260528/a.zip", line("20260528", 1))
    put("20260529/a.zip", line("20260529", 2), line("x", 2))
    folder.put("raw/20260601/a.zip", "broken")
    first = {("2026-05-28", 1), ("2026-05-29", 2)}
    assert load() == first
    assert load() == first
    put("20260529/b.zip", line("20260529", 5))
    put("20260602/a.zip", line("20260602", 7))
    assert load() == {("2026-05-28", 1), ("2026-05-29", 7), ("2026-06-02", 7)}
    errors = spark.read.parquet(lake.file_errors).collect()
    assert [r.path.rpartition("raw/")[2] for r in errors] == ["20260601/a.zip"]
    rejects = spark.read.parquet(lake.rejects("ticks")).collect()
    assert [(r.path.rpartition("raw/")[2], r.member) for r in rejects] == [("20260529/a.zip", "t.csv")]
    # A better file for the damaged day clears its error.
    put("20260601/a.zip", line("20260601", 4))
    put("20260601/b.zip", line("20260601", 1))
    assert load() == {("2026-05-28", 1), ("2026-05-29", 7), ("2026-06-01", 5), ("2026-06-02", 7)}
    assert read_or_empty(spark, lake.file_errors, "path string", recursiveFileLookup="true").count() == 0
