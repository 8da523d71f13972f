"""Physical plans: what is pushed down, shuffled, broadcast and limited."""

import datetime as dt
import pathlib
import re

import pytest

import __spark_entry__ as entry
from tickloom import samples
from tickloom.operators import panels
from tickloom.operators.replace import on_days, replace_dates
from tickloom.operators.rollup import tick_summary
from tickloom.registry.queries import all_queries
from tickloom.sinks.tables import write_table
from tickloom.sources.tables import read_dates

SF = "/root/testdata/sf0.001"
CHOSEN = panels.Selection(["U1"], ["click"], dt.date(2024, 1, 3), dt.date(2024, 1, 5))
FILE_QUERIES = {
    "delimited_ticks", "delimited_cancels", "zip_ticks", "daily_load", "quarantine",
    "csv_round_trip", "partition_replace", "serving_replace", "batch_dates", "compaction",
    "retention_candidates", "run_log_latest", "incremental_load", "stream_replace",
    "stream_hourly", "stream_archives", "stray_date_load", "damaged_part_load", "emptied_day_load",
    "quarantine_reload", "daily_load_csv", "load_balance", "stream_hourly_corrected",
    "clustered_compaction", "total_volume_range", "summary_of_picked_days", "distinct_symbols_range", "vwap_sql", "incremental_rejects", "split_day_stream",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)  # whole filter lists in plans
    path = str(tmp_path_factory.mktemp("summary"))
    write_table(tick_summary(samples.ticks(spark, SF)), path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("panel", [
    panels.total_volume, panels.total_ticks, panels.vwap_series, panels.hourly_liquidity,
    panels.market_share, panels.trade_detail, panels.mean_prices,
])
def test_selection_prunes_partitions_and_reaches_the_scan(stored, panel):
    text = plan(panel(stored, CHOSEN))
    partitions = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "TradeDateParsed" in partitions and "2024-01-03" in partitions
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(Symbol,U1)" in pushed and "EqualTo(MessageCode,click)" in pushed


def test_only_needed_columns_are_read(stored):
    text = plan(panels.total_volume(stored))
    assert "ReadSchema: struct<Symbol:string,MessageCode:string,GroupVolume:bigint>" in text


def test_summary_has_one_shuffle_after_partial_sums(spark):
    text = plan(tick_summary(samples.ticks(spark, SF)))
    assert text.count("Exchange") == 1
    assert text.index("functions=[sum(") < text.index("Exchange") < text.index("partial_sum(")


def test_detail_takes_ordered_rows(stored):
    assert "TakeOrderedAndProject(limit=500" in plan(panels.trade_detail(stored))
    assert "TakeOrderedAndProject(limit=10" in plan(panels.sample_rows(stored))


def test_touched_dates_list_their_folders_only(spark, tmp_path):
    write_table(tick_summary(samples.ticks(spark, SF)), str(tmp_path))
    some = read_dates(spark, str(tmp_path), [dt.date(2024, 1, 3), dt.date(2024, 1, 9)])
    assert len(some.inputFiles()) == 2
    assert [r[0] for r in some.select("TradeDateParsed").distinct().orderBy("TradeDateParsed").collect()] == [
        dt.date(2024, 1, 3), dt.date(2024, 1, 9)
    ]


def test_dates_are_broadcast_other_keys_are_not(spark, stored):
    assert "BroadcastHashJoin" in plan(replace_dates(stored, stored))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" not in plan(replace_dates(stored, stored, "Symbol"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(all_queries()) - FILE_QUERIES))
def test_no_cross_joins_python_or_whole_table_windows(spark, name):
    text = plan(all_queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "InArrow", "Window ["):
        assert bad not in text


def test_library_collects_no_data():
    """Only small facts reach the driver: header lines, rows per day, some of the file errors."""
    found = []
    package = pathlib.Path(entry.__file__).parent / "tickloom"
    for source in sorted(package.glob("**/*.py")):
        if "llm" in source.relative_to(package).parts:
            continue
        for line in source.read_text().splitlines():
            if re.search(r"\.(collect|toPandas|toLocalIterator|rdd|localCheckpoint|cache|persist)\(", line):
                found.append((source.name, line.strip()))
    assert sorted(found) == [
        ("cli.py", 'for row in done.file_errors.orderBy("path").limit(20).collect():'),
        ("days.py", "rows = per_day.repartition(1).limit(CALENDAR_DAYS + 1).collect()"),
        ("delimited.py", "for row in headers.where(\"header is not null\").toLocalIterator():"),
        ("delimited.py", "return sorted(row.header for row in lines.collect())"),
    ]


def test_days_picked_at_run_time_prune_folders(spark, stored):
    """Only the folders of the picked days are read."""
    wanted = [dt.date(2024, 1, 3), dt.date(2024, 1, 9), dt.date(2024, 1, 20)]
    offered = spark.createDataFrame(
        [(day, n) for n, day in enumerate([*wanted, dt.date(2024, 1, 4), None])], "TradeDateParsed date, n int"
    )
    found = on_days(stored, offered.where("n < 3"))
    assert "dynamicpruning" in plan(found)
    assert sorted({r.TradeDateParsed for r in found.collect()}) == wanted
    final = found._jdf.queryExecution().executedPlan().executedPlan()
    leaves = (final.plan() if final.nodeName() == "ResultQueryStage" else final).collectLeaves()
    metrics = [leaves.apply(n).metrics() for n in range(leaves.size())]
    assert [m.apply("numPartitions").value() for m in metrics if m.contains("numPartitions") and m.contains("filesSize")] == [3]
