"""Levels, symbol sets and clustered files: what is rewritten, and what is read."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from tickloom import samples
from tickloom.operators import levels, symbolsets
from tickloom.operators.panels import Selection
from tickloom.operators.rollup import tick_summary
from tickloom.schemas import DATE_KEY
from tickloom.sinks.tables import write_table
from tickloom.sinks.upkeep import cluster

SF = "/root/testdata/sf0.001"


def test_cover():
    day = dt.date
    assert levels.cover(day(2024, 1, 1), day(2024, 2, 29)) == ((day(2024, 1, 1), day(2024, 2, 1)), [])
    assert levels.cover(day(2024, 1, 2), day(2024, 3, 1)) == (
        (day(2024, 2, 1), day(2024, 2, 1)), [(day(2024, 1, 2), day(2024, 1, 31)), (day(2024, 3, 1), day(2024, 3, 1))]
    )
    assert levels.cover(day(2024, 1, 2), day(2024, 2, 28)) == (None, [(day(2024, 1, 2), day(2024, 2, 28))])
    assert levels.cover(day(2024, 1, 2), day(2024, 1, 1)) == (None, [])
    start = day(2023, 12, 28)
    for a in range(40):
        for b in range(a, 100, 7):
            first, last = start + dt.timedelta(a), start + dt.timedelta(b)
            months, edges = levels.cover(first, last)
            days = [d for edge in edges for d in levels._dates(*edge)]
            month = months[0] if months else None
            while month and month <= months[1]:
                days += levels._dates(month, levels._next_month(month) - dt.timedelta(1))
                month = levels._next_month(month)
            assert sorted(days) == levels._dates(first, last)


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}


def test_only_touched_months_are_rewritten(spark, folder):
    ticks = samples.ticks_of_months(spark, SF)
    made = levels.Levels(str(folder))
    summary = f"{folder}/summary"
    write_table(tick_summary(ticks), summary)
    levels.refresh_levels(spark, summary, made, levels.all_dates(ticks))
    before = files(folder)
    chosen = Selection(symbols=[r.Symbol for r in ticks.select("Symbol").distinct().limit(5).collect()])

    def check(rows):
        for ends in ((dt.date(2024, 1, 20), dt.date(2024, 3, 10)), (dt.date(2024, 2, 1), dt.date(2024, 2, 29))):
            for selection in (Selection(), chosen):
                inside = Selection(selection.symbols, None, *ends).apply(rows)
                got = levels.total_volume_range(spark, made, *ends, selection).first()[0]
                assert got == inside.agg(F.sum("TradeVolume")).first()[0]

    check(ticks)
    day = dt.date(2024, 2, 12)
    changed = F.when(F.col(DATE_KEY) == day, F.col("TradeVolume") + 5).otherwise(F.col("TradeVolume"))
    corrected = ticks.withColumn("TradeVolume", changed)
    write_table(tick_summary(corrected.where(F.col(DATE_KEY) == F.lit(day))), summary)
    assert levels.refresh_levels(spark, summary, made, [day]) == [dt.date(2024, 2, 1)]
    check(corrected)
    new = {name.rpartition("/")[0] for name, when in files(folder).items() if before.get(name) != when}
    assert new == {
        f"summary/{DATE_KEY}=2024-02-12", f"summary_days/{DATE_KEY}=2024-02-12", "summary_months/Month=2024-02-01"
    }


def test_a_month_without_rows_is_emptied(spark, folder):
    ticks = samples.ticks_of_months(spark, SF).where("TradeDateParsed < '2024-03-01'")
    made, summary = levels.Levels(str(folder)), f"{folder}/summary"
    write_table(tick_summary(ticks), summary)
    dates = levels.all_dates(ticks)
    levels.refresh_levels(spark, summary, made, dates)
    levels.refresh_levels(spark, f"{folder}/nothing", made, [d for d in dates if d.month == 2])
    total = ticks.where("TradeDateParsed < '2024-02-01'").agg(F.sum("TradeVolume")).first()[0]
    assert levels.total_volume_range(spark, made, dt.date(2024, 1, 1), dt.date(2024, 2, 29)).first()[0] == total


def test_symbol_sets_add_up(spark, folder):
    rows = spark.range(60_000).select(
        F.concat(F.lit("S"), F.col("id") % 5_000 + (F.col("id") % 3) * 2_000).alias("Symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias(DATE_KEY),
    )
    for day in (1, 2, 3, 2):
        symbolsets.refresh_sets(rows.where(F.col(DATE_KEY) == F.lit(dt.date(2024, 1, day))), str(folder))
    dictionary = spark.read.parquet(f"{folder}/dictionary")
    assert dictionary.count() == dictionary.select("number").distinct().count() == dictionary.select("Symbol").distinct().count()
    for days in ([1], [2, 3], [1, 2, 3], [9]):
        chosen = [dt.date(2024, 1, d) for d in days]
        found = symbolsets.distinct_symbols(spark, str(folder), chosen).first()
        exact = rows.where(F.col(DATE_KEY).isin(chosen)).select("Symbol").distinct().count()
        assert found.symbols == exact and abs(found.estimate - exact) <= 0.05 * exact


def _rows_read(frame):
    """Rows that the scan of a query hands on."""
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_a_symbol_of_clustered_files_is_a_small_share_of_the_scan(spark, folder):
    day = dt.date(2024, 1, 3)
    n = F.col("id")
    rows = spark.range(300_000).select(
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(300))).alias("Symbol"), F.lit(day).alias(DATE_KEY),
        (n % 24).cast("string").alias("Hour"), F.sha2(n.cast("string"), 256).alias("other"),
    )
    path = f"{folder}/t"
    rows.repartition(8).write.partitionBy(DATE_KEY).parquet(path)
    total = rows.count()
    one = lambda: spark.read.parquet(path).where("Symbol = 'S17'").select("Hour", "other")
    before, expected = _rows_read(one()), sorted(map(tuple, one().collect()))
    assert before > total / 2
    cluster(spark, path, [day], ["Symbol", "Hour"], target_bytes=8 << 20, row_group_bytes=1 << 19)
    stored = spark.read.parquet(path)
    assert stored.count() == total and sorted(map(tuple, one().collect())) == expected
    assert _rows_read(one()) < total / 20
