"""A key that holds a third of the rows changes neither results nor the shape of the work."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import panels, runs
from tickloom.operators.rollup import tick_summary
from tickloom.sinks.tables import write_table

ROWS = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Ticks of which a third share symbol, code, date and hour."""
    n = F.col("id")
    third = n % 3 == 0
    return spark.range(ROWS).repartition(8).select(
        F.when(third, "HOT").otherwise(F.concat(F.lit("S"), n % 50)).alias("Symbol"),
        F.when(third, "T").otherwise(F.chr(65 + n % 4)).alias("MessageCode"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(third, 0).otherwise(n % 7).cast("int"))
        .alias("TradeDateParsed"),
        F.when(third, "090000").otherwise(F.concat(10 + n % 12, F.lit("0000"))).alias("TradeTime"),
        ((n % 977) / 4).cast("decimal(18,4)").alias("TradePrice"),
        (n % 11).cast("int").alias("TradeVolume"),
    )


def test_summary(spark, hot):
    expected = defaultdict(lambda: [0, 0, Decimal(0), Decimal(0)])
    for r in hot.collect():
        sums = expected[r.TradeDateParsed, r.Symbol, r.MessageCode, r.TradeTime[:2]]
        sums[0] += r.TradeVolume
        sums[1] += 1
        sums[2] += r.TradePrice * r.TradeVolume
        sums[3] += r.TradePrice
    got = {tuple(r)[:4]: list(r)[4:] for r in tick_summary(hot).collect()}
    assert got == dict(expected)
    assert max(v[1] for v in got.values()) == ROWS // 3


def test_rows_are_summed_before_the_shuffle(spark, hot):
    """The hot group crosses the shuffle as one row per task."""
    summary = tick_summary(hot)
    summary.collect()
    written = [
        stage.metrics().apply("shuffleRecordsWritten").value()
        for stage in _shuffles(summary._jdf.queryExecution().executedPlan())
    ]
    groups = summary.count()
    assert written and written[-1] <= 8 * groups < ROWS


def _shuffles(plan):
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _shuffles(plan.executedPlan())
        return
    if name.startswith(("ShuffleQueryStage", "ResultQueryStage")):
        yield from _shuffles(plan.plan())
        return
    children = plan.children()
    for i in range(children.size()):
        yield from _shuffles(children.apply(i))
    if name == "Exchange":
        yield plan


def test_panels_and_tables(spark, hot, tmp_path):
    write_table(tick_summary(hot), str(tmp_path / "s"))
    summary = spark.read.parquet(str(tmp_path / "s"))
    total = panels.total_ticks(summary).first()[0]
    assert total == ROWS
    share = panels.with_share(panels.market_share(summary)).orderBy(F.desc("value")).first()
    assert share.metric == "HOT" and 0.3 < share.share < 0.36


def test_latest_run_of_a_busy_day(spark):
    n = F.col("id")
    log = spark.range(ROWS).select(
        F.when(n % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-02-"), 10 + n % 15)).alias("job_date"),
        F.when(n == ROWS - 3, "success").otherwise("failed").alias("status"),
        F.timestamp_seconds(n).alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(None).cast("string").alias("results"),
    )
    state = {r.job_date: r.status for r in runs.latest_runs(log).collect()}
    assert len(state) == 11 and state["2024-01-01"] == "success"
