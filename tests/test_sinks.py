"""Partition replacement, compaction, retention and the serving table."""

import datetime as dt
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.operators.replace import replace_dates, touched_dates
from tickloom.operators.rollup import tick_summary
from tickloom.samples import ticks
from tickloom.schemas import DATE_KEY, RUN_LOG, SUMMARY
from tickloom.session import settings
from tickloom.sinks import serving, tables, upkeep
from tickloom.sources.files import list_files
from tickloom.sources import tables as stored
from tickloom.sources.tables import read_serving, read_summary_csv

SF = "/root/testdata/sf0.001"


def rows(frame):
    return Counter(tuple(row) for row in frame.select(*sorted(frame.columns)).collect())


def files_in(path, pattern="*.parquet"):
    return sorted(pathlib.Path(str(path)).rglob(pattern))


@pytest.fixture(scope="module")
def summary(spark):
    return tick_summary(ticks(spark, SF))


def test_only_touched_partitions_change(spark, folder, summary):
    path = f"{folder}/t"
    tables.write_table(summary, path)
    before = {p: p.stat().st_mtime_ns for p in files_in(path)}
    batch = summary.where(F.col(DATE_KEY) == "2024-01-05").withColumn("GroupVolume", F.lit(1).cast("bigint"))
    for _ in range(2):
        tables.write_table(batch, path)
    untouched = [p for p in before if "2024-01-05" not in str(p)]
    assert all(p.exists() and p.stat().st_mtime_ns == before[p] for p in untouched)
    assert len(files_in(path)) == len(before)
    expected = replace_dates(summary, batch)
    assert rows(spark.read.parquet(path)) == rows(expected)


def test_empty_batch_touches_nothing(spark, folder, summary):
    path = f"{folder}/t"
    tables.write_table(summary, path)
    tables.write_table(summary.where("false"), path)
    assert rows(spark.read.parquet(path)) == rows(summary)


def test_one_file_per_date_and_split_hot_date(spark, folder, summary):
    tables.write_csv(summary, f"{folder}/c")
    dates = summary.select(DATE_KEY).distinct().count()
    assert len(files_in(f"{folder}/c", "*.csv")) == dates
    # A date with most of the rows is written by several tasks once it is large.
    hot = spark.range(400_000).select(
        F.col("id"), F.when(F.col("id") % 3 < 2, "2024-01-01").otherwise("2024-01-02")
        .cast("date").alias(DATE_KEY), F.sha2(F.col("id").cast("string"), 256).alias("x"),
    ).repartition(8)
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}):
        tables.write_table(hot, f"{folder}/hot")
    assert len(files_in(f"{folder}/hot/{DATE_KEY}=2024-01-01")) > 2
    assert spark.read.parquet(f"{folder}/hot").count() == 400_000


def test_csv_round_trip_keeps_values_and_types(spark, folder, summary):
    tables.write_csv(summary, f"{folder}/c")
    back = read_summary_csv(spark, f"{folder}/c")
    assert back.schema == SUMMARY
    assert rows(back) == rows(summary)


def test_csv_round_trip_of_odd_text(spark, folder, summary):
    odd = ["\tNK", " a ", 'q"x', "a,b", None, "back\\slash", "é"]
    one = summary.limit(1).drop("Symbol", "Hour").crossJoin(
        spark.createDataFrame([(s, None if s is None else "09") for s in odd], "Symbol string, Hour string")
    )
    tables.write_csv(one.select(*summary.columns), f"{folder}/c")
    assert {r.Symbol for r in read_summary_csv(spark, f"{folder}/c").collect()} == set(odd)


def test_write_watch(spark, folder, summary):
    with_null = summary.withColumn(
        DATE_KEY, F.when(F.col(DATE_KEY) > "2024-01-02", F.col(DATE_KEY))
    )
    watch = tables.WriteWatch(with_null, late=F.col("Hour") > "11", undated=F.col(DATE_KEY).isNull())
    watch.watched.write.parquet(f"{folder}/w")
    days = sorted(r[0] for r in touched_dates(with_null).collect())
    assert tables.batch_dates(with_null, watch) == days and len(days) > 20
    assert watch.counts["rows"] == summary.count()
    assert watch.counts["undated"] == with_null.where(f"{DATE_KEY} is null").count() > 0
    assert watch.counts["late"] == summary.where("Hour > '11'").count()


@pytest.mark.parametrize("days", [
    [dt.date(1950, 6, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2039, 2, 3)],
    [dt.date(1, 1, 1), dt.date(2026, 5, 29), dt.date(9999, 12, 31)],
    [],
])
def test_write_watch_over_long_spans(spark, folder, days):
    batch = spark.createDataFrame([(d,) for d in days], f"{DATE_KEY} date")
    watch = tables.WriteWatch(batch)
    watch.watched.write.parquet(f"{folder}/w")
    assert tables.batch_dates(batch, watch) == days


def test_compaction_keeps_rows_and_settles(spark, folder, summary):
    path = f"{folder}/t"
    summary.repartition(6).write.partitionBy(DATE_KEY).parquet(path)
    tables.write_table(summary.where(F.col(DATE_KEY) == "2024-01-03"), path)
    whole = files_in(f"{path}/{DATE_KEY}=2024-01-03")
    dates = upkeep.compact(spark, path)
    assert dt.date(2024, 1, 3) not in dates and len(dates) > 20
    assert files_in(f"{path}/{DATE_KEY}=2024-01-03") == whole
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in pathlib.Path(path).glob("Trade*"))
    assert rows(spark.read.parquet(path)) == rows(summary)
    assert upkeep.compact(spark, path) == []


def test_compaction_splits_a_large_date(spark, folder):
    path = f"{folder}/t"
    big = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
        F.lit("2024-01-01").cast("date").alias(DATE_KEY),
    )
    big.repartition(16).write.partitionBy(DATE_KEY).parquet(path)
    size = sum(p.stat().st_size for p in files_in(path))
    upkeep.compact(spark, path, target_bytes=size // 4)
    sizes = [p.stat().st_size for p in files_in(path)]
    assert 3 <= len(sizes) <= 5
    assert max(sizes) < size
    assert rows(spark.read.parquet(path)) == rows(big)


def test_retention_and_deletion(spark, folder):
    for name in ("old/a.parquet", "old/b.parquet", "live/c.parquet"):
        folder.put(f"t/{name}", "x")
    listing = list_files(spark, f"{folder}/t")
    live = list_files(spark, f"{folder}/t/live")
    now = dt.datetime.now()
    assert upkeep.retention_candidates(listing, live, now).isEmpty()
    later = now + dt.timedelta(hours=169)
    old = upkeep.retention_candidates(listing, live, later)
    assert sorted(r.path.rpartition("/")[2] for r in old.collect()) == ["a.parquet", "b.parquet"]
    assert len(files_in(f"{folder}/t")) == 3  # nothing is deleted by looking
    done = upkeep.delete_files(old).collect()
    assert [r.error for r in done] == [None, None]
    assert [p.name for p in files_in(f"{folder}/t")] == ["c.parquet"]


def test_run_log_table(spark, folder):
    path = f"{folder}/runs"
    for _ in range(2):
        name = tables.ensure_run_log(spark, "default", "ingestion_runs_test", path)
    try:
        started = dt.datetime(2026, 5, 29, 22)
        entry = spark.createDataFrame(
            [("2026-05-29", "running", started, None, None), ("2026-05-29", "it's", started, None, "'")],
            RUN_LOG,
        )
        tables.append_runs(entry, path)
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == 2
        assert spark.table(name).columns == RUN_LOG.fieldNames()
    finally:
        spark.sql(f"DROP TABLE {name}")


class StoredTable:
    """Stands in for the serving database: a Parquet folder behind the JDBC calls."""

    def __init__(self, spark, path, monkeypatch):
        self.spark, self.path = spark, path
        monkeypatch.setattr(
            serving, "read_whole_serving", lambda *_, **__: spark.read.parquet(path)
        )
        monkeypatch.setattr(serving, "serving_exists", lambda *_, **__: True)
        monkeypatch.setattr(
            serving, "refresh_serving", lambda df, *_, **__: df.write.mode("overwrite").parquet(path)
        )


def test_serving_replacement_is_repeatable(spark, folder, summary, monkeypatch):
    store = StoredTable(spark, f"{folder}/serving", monkeypatch)
    summary.write.parquet(store.path)
    batch = summary.where(F.col(DATE_KEY) >= "2024-01-20").withColumn("GroupVolume", F.lit(7).cast("bigint"))
    undated = batch.limit(3).withColumn(DATE_KEY, F.lit(None).cast("date"))
    for _ in range(2):
        serving.replace_serving(batch.unionByName(undated), "jdbc:x", "t")
    assert rows(spark.read.parquet(store.path)) == rows(
        summary.where(F.col(DATE_KEY) < "2024-01-20").unionByName(batch)
    )


class Recorder:
    """Records the calls made on a reader or writer."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            pair = dict([args]) if len(args) == 2 else {}
            self.seen[name] = {**self.seen.get(name, {}), **kwargs, **pair}
            self.seen.setdefault("order", []).append((name, args))
            return self

        return call


def test_jdbc_options():
    class Frame:
        write = Recorder()

    serving.append_serving(Frame, "jdbc:x", "t", user="u")
    assert Frame.write.seen["options"] == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "numPartitions": "8", "user": "u"
    }
    assert ("mode", ("append",)) in Frame.write.seen["order"]
    Frame.write = Recorder()
    serving.refresh_serving(Frame, "jdbc:x", "t")
    assert ("mode", ("overwrite",)) in Frame.write.seen["order"]
    assert Frame.write.seen["option"] == {"truncate": True}

    class Session:
        read = Recorder()

    read_serving(Session, "jdbc:x", "t", dt.date(2024, 1, 1), dt.date(2024, 1, 31), user="u")
    assert Session.read.seen["options"]["partitionColumn"] == DATE_KEY
    assert Session.read.seen["options"]["lowerBound"] == "2024-01-01"


def test_serving_is_read_in_slices_of_its_own_range(spark, summary, monkeypatch):
    calls = []

    def read(_, url, table, first=None, last=None, **options):
        calls.append((first, last, options))
        return summary

    monkeypatch.setattr(stored, "read_serving", read)
    assert stored.read_whole_serving(spark, "jdbc:x", "t", user="u") is summary
    span = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    assert calls == [(None, None, {"user": "u"}), (*span, {"user": "u"})]
