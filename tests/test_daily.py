"""Whole loads over small raw zones."""

import datetime as dt
import decimal
import io
import pathlib
import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom import cli
from tickloom.operators.rollup import tick_summary
from tickloom.operators.runs import requested_days
from tickloom.plans import backfill as ranges
from tickloom.plans.daily import (
    Lake,
    load_ticks,
    publish_staged,
    refresh_summary,
    register_views,
    run_cancel_load,
    run_tick_load,
    stage_archives,
)
from tickloom.schemas import CANCELS, RAW_CANCEL_COLUMNS, RAW_TICK_COLUMNS, SUMMARY, TICKS
from tickloom.sinks import serving
from tickloom.sources.archives import ArchiveRead, read_checked_ticks
from tickloom.sources.files import list_files
from tickloom.sources.tables import read_or_empty, read_summary_csv

FRIDAY, MONDAY, TUESDAY = dt.date(2026, 5, 29), dt.date(2026, 6, 1), dt.date(2026, 6, 2)


def key(day):
    return day.strftime("%Y%m%d")


def put_ticks(folder, day, *rows):
    """Archive of one day; a row is (symbol, clock, price, volume)."""
    lines = [",".join(RAW_TICK_COLUMNS)] + [
        f"{s},F,M,2026,0,{clock},T,{key(day)},{price},{volume}" for s, clock, price, volume in rows
    ]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        out.writestr("ticks.csv", "\n".join(lines))
    folder.put(f"raw/{key(day)}/WEBPXTICK_DT_{key(day)}.zip", buffer.getvalue())


def put_cancels(folder, day, *prices):
    lines = ["\t".join(RAW_CANCEL_COLUMNS)] + [
        f"NK\tF\tM\t2026\t0\t{key(day)}\t90501\tP\tT\tC\t{price}\t1" for price in prices
    ]
    folder.put(f"raw/{key(day)}/TC_{key(day)}.txt", "\n".join(lines))


@pytest.fixture
def zone(folder):
    put_ticks(
        folder, FRIDAY,
        ("NK", "90501", "10.5", "2"), ("NK", "095900", "11", "4"), ("CN", "100000", "", "5"),
    )
    put_ticks(folder, MONDAY, ("NK", "90501", "20", "1"), ("NK", "90502", "bad", "1"))
    folder.put(f"raw/{key(TUESDAY)}/WEBPXTICK_DT_{key(TUESDAY)}.zip", "broken")
    put_cancels(folder, FRIDAY, "1050", "1100")
    return folder


@pytest.fixture
def lake(folder):
    return Lake(f"{folder}/lake")


def days(spark, first=FRIDAY, last=TUESDAY):
    return requested_days(spark, first=first, last=last)


def volumes(spark, lake):
    rows = spark.read.parquet(lake.summary).collect()
    return {(r.TradeDateParsed, r.Symbol, r.Hour): r.GroupVolume for r in rows}


EXPECTED = {(FRIDAY, "NK", "09"): 6, (FRIDAY, "CN", "10"): 5, (MONDAY, "NK", "09"): 2}


def test_load_skips_broken_days_and_reports(spark, zone, lake):
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    assert (done.dates, done.rows, done.rejected) == ([FRIDAY, MONDAY], 5, 1)
    assert [r.path.rpartition("/")[2] for r in done.file_errors.collect()] == [f"WEBPXTICK_DT_{key(TUESDAY)}.zip"]
    assert volumes(spark, lake) == EXPECTED
    ticks = spark.read.parquet(lake.ticks)
    assert sorted(ticks.columns) == sorted(TICKS.fieldNames())
    assert spark.read.parquet(lake.rejects("ticks")).select("Price").first().Price == "bad"
    names = SUMMARY.fieldNames()
    assert sorted(map(str, spark.read.parquet(lake.summary).select(*names).collect())) == sorted(
        map(str, tick_summary(ticks).select(*names).collect())
    )


def test_repeated_and_corrected_loads(spark, zone, lake):
    for _ in range(2):
        run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    assert volumes(spark, lake) == EXPECTED
    assert spark.read.parquet(lake.rejects("ticks")).count() == 1
    put_ticks(zone, MONDAY, ("NK", "90501", "20", "9"))
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark, MONDAY, MONDAY))
    assert done.dates == [MONDAY]
    assert volumes(spark, lake) == {**EXPECTED, (MONDAY, "NK", "09"): 9}
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    assert rejected(spark, lake) == []


def rejected(spark, lake):
    schema = "Volume string, reasons array<string>, path string, member string"
    rows = read_or_empty(spark, lake.rejects("ticks"), schema, recursiveFileLookup="true").collect()
    return sorted((r.Volume, r.reasons[0], r.path.rpartition("/")[2], r.member) for r in rows)


def test_rows_of_another_date_touch_no_other_day(spark, zone, lake):
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    name = f"WEBPXTICK_DT_{key(MONDAY)}.zip"
    lines = [",".join(RAW_TICK_COLUMNS)] + [
        f"NK,F,M,2026,0,90501,T,{key(day)},1,{volume}" for day, volume in ((MONDAY, 3), (FRIDAY, 7))
    ]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        out.writestr("ticks.csv", "\n".join(lines))
    zone.put(f"raw/{key(MONDAY)}/{name}", buffer.getvalue())
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark, MONDAY, MONDAY))
    assert (done.dates, done.rows, done.rejected) == ([MONDAY], 1, 1)
    assert volumes(spark, lake) == {**EXPECTED, (MONDAY, "NK", "09"): 3}
    assert rejected(spark, lake) == [("7", "other date than the file's", name, "ticks.csv")]


def test_staged_archives_are_read_once(spark, folder, lake):
    """Ticks, rejects and totals come from the staged lines: the archives are gone by then."""
    put_ticks(folder, FRIDAY, ("NK", "90501", "10.5", "2"), ("Comm", "x", "x", "x"), ("", "90502", "1", "1"))
    put_ticks(folder, MONDAY, ("NK", "90501", "bad", "1"), ("NK", "90501", "1", "1"))
    listing = list_files(spark, f"{folder}/raw", "*.zip")
    staged = stage_archives(spark, listing)
    for file in pathlib.Path(folder, "raw").glob("*/*.zip"):
        file.unlink()
    done = publish_staged(spark, staged, lake)
    assert (done.rows, done.rejected, done.dates) == (3, 1, [FRIDAY, MONDAY])
    assert volumes(spark, lake) == {(FRIDAY, "NK", "09"): 2, (MONDAY, "NK", "09"): 2}
    assert [r.Price for r in spark.read.parquet(lake.rejects("ticks")).collect()] == ["bad"]
    totals = {r.file_day: r for r in spark.read.parquet(lake.totals).collect()}
    assert [totals[FRIDAY][c] for c in ("lines", "clean", "header", "keyless")] == [3, 1, 1, 1]
    assert [totals[MONDAY][c] for c in ("lines", "clean", "repaired")] == [2, 1, 1]


def test_totals_that_do_not_add_up_hold_a_day_back(spark, zone, lake, monkeypatch):
    from tickloom.plans import daily

    whole = daily.read_checked_ticks

    def losing(listing):
        read = whole(listing)
        return ArchiveRead(read.rows.where("NOT (is_line AND Price <=> '20')"), read.errors)

    monkeypatch.setattr(daily, "read_checked_ticks", losing)
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    assert volumes(spark, lake) == {k: v for k, v in EXPECTED.items() if k[0] == FRIDAY}
    errors = {r.path.rpartition("/")[2]: r.error for r in done.file_errors.collect()}
    assert errors[f"WEBPXTICK_DT_{key(MONDAY)}.zip"] == "lines read: 2, accounted for: 1"


def test_large_members_are_spread_and_small_ones_are_not(spark, zone):
    listing = list_files(spark, f"{zone}/raw", "*.zip")
    plans = {}
    for size in (1, 1 << 30):
        rows = read_checked_ticks(listing, spread_bytes=size).rows.where("is_line")
        assert rows.count() == 5
        plans[size] = rows._jdf.queryExecution().executedPlan().toString()
    # One branch for each kind, of which one has rows.
    assert all(p.count("REBALANCE_PARTITIONS_BY_COL") == 1 and p.count("MapInArrow") == 2 for p in plans.values())


def test_an_emptied_day_and_a_damaged_one(spark, zone, lake):
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    put_ticks(zone, MONDAY)
    assert run_tick_load(spark, f"{zone}/raw", lake, days(spark, MONDAY, MONDAY)).rows == 0
    friday = {k: v for k, v in EXPECTED.items() if k[0] == FRIDAY}
    assert volumes(spark, lake) == friday and rejected(spark, lake) == []
    put_ticks(zone, FRIDAY, ("NK", "90501", "1", "99"))
    zone.put(f"raw/{key(FRIDAY)}/more/WEBPXTICK_DT_{key(FRIDAY)}.zip", "broken")
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark, FRIDAY, FRIDAY))
    assert done.dates == [] and done.file_errors.count() == 1
    assert volumes(spark, lake) == friday


def test_frames_without_files_replace_the_dates_of_their_rows(spark, folder, lake):
    put_ticks(folder, FRIDAY, ("NK", "90501", "1", "1"))
    raw = spark.createDataFrame(
        [("NK", "F", "M", "2026", "0", "90501", "T", d, "1", "1") for d in (key(FRIDAY), key(MONDAY), "x")],
        RAW_TICK_COLUMNS,
    )
    done = load_ticks(raw, lake, "mixed")
    assert (done.dates, done.rows, done.rejected) == ([FRIDAY, MONDAY], 2, 1)


def test_no_input(spark, folder, lake):
    folder.put("raw/readme", "x")
    done = run_tick_load(spark, f"{folder}/raw", lake, days(spark))
    assert (done.dates, done.rows) == ([], 0)
    assert run_cancel_load(spark, f"{folder}/raw", lake, days(spark)).dates == []


def test_cancels(spark, zone, lake):
    done = run_cancel_load(spark, f"{zone}/raw", lake, days(spark))
    assert (done.dates, done.rows) == ([FRIDAY], 2)
    table = spark.read.parquet(lake.cancels)
    assert sorted(table.columns) == sorted(CANCELS.fieldNames())
    assert sorted(r.Price for r in table.collect()) == [10.5, 11.0]


def test_sql_over_the_tables(spark, zone, lake):
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    run_cancel_load(spark, f"{zone}/raw", lake, days(spark))
    register_views(spark, lake)
    total = """
        SELECT sum(GroupVolume) AS volume FROM ticks_summary
        WHERE TradeDateParsed BETWEEN :first AND :last AND array_contains(:symbols, Symbol)
    """
    chosen = {"first": FRIDAY, "last": MONDAY, "symbols": F.array(F.lit("NK"), F.lit("it's"))}
    assert spark.sql(total, args=chosen).first().volume == 8
    assert spark.sql("SELECT count(*) AS n FROM ticks").first().n == 5
    assert spark.sql("SELECT max(Price) AS p FROM trade_cancellations").first().p == 11.0


def test_sql_before_the_first_load(spark, lake):
    register_views(spark, lake)
    assert spark.sql("SELECT count(*) AS n FROM trade_cancellations").first().n == 0
    assert spark.sql("SELECT hour_bucket('9:05:01') AS h, weighted_price(-10, 4) AS p").first()[:] == (
        "09", decimal.Decimal("-2.5000")
    )


def test_summary_as_text(spark, zone, lake):
    done = run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    refresh_summary(spark, lake, done.dates, as_csv=True)
    text = read_summary_csv(spark, lake.summary_csv)
    assert text.schema == SUMMARY
    assert {r.GroupVolume for r in text.collect()} == {6, 5, 2}


def test_landing_record_and_backfill(spark, zone, lake):
    last = dt.date(2026, 6, 3)
    current = ranges.record_landing(spark, f"{zone}/raw", lake, days(spark, last=last))
    state = {r.job_date: r.status for r in current.collect()}
    assert state == {
        "2026-05-29": "success", "2026-06-01": "failed", "2026-06-02": "failed", "2026-06-03": "failed",
    }
    probes = spark.createDataFrame(
        [(last, 1, 404, None, None)],
        "job_date date, feed_id long, status_code int, content_disposition string, error string",
    )
    ranges.record_landing(spark, f"{zone}/raw", lake, days(spark, last, last), probes)
    log = ranges.read_runs(spark, lake).where("job_date = '2026-06-03'").collect()
    assert sorted(r.status for r in log) == ["failed", "running", "running", "skipped"]
    assert all((r.ended_at is None) == (r.status == "running") for r in log)
    result = ranges.backfill(spark, f"{zone}/raw", lake, days(spark, last=last))
    actions = {r.job_date: r.action for r in result.plan.collect()}
    assert actions == {FRIDAY: "etl", MONDAY: "land", TUESDAY: "land", last: "skip"}
    assert result.ticks.dates == [FRIDAY] and result.cancels.dates == [FRIDAY]
    assert {r.status: r.days for r in result.report.collect()} == {
        "success": "2026-05-29", "land": "2026-06-01,2026-06-02", "skipped": "2026-06-03",
    }
    every = ranges.backfill(spark, f"{zone}/raw", lake, days(spark, last=last), skip_ingestion=True)
    assert every.ticks.dates == [FRIDAY, MONDAY]
    assert "2026-06-02" in {r.status: r.days for r in every.report.collect()}["failed"]
    assert volumes(spark, lake) == EXPECTED
    assert ranges.maintain(spark, lake) == {lake.ticks: [], lake.cancels: []}


def test_expired_intermediates(spark, folder, monkeypatch):
    monkeypatch.setattr(ranges, "shared_root", lambda _: str(folder))
    folder.put("tickloom/compact-1/x.parquet", "x")
    folder.put("other/y.parquet", "y")
    now = dt.datetime.now()
    assert ranges.drop_expired(spark, now).isEmpty()
    gone = ranges.drop_expired(spark, now + dt.timedelta(hours=169)).collect()
    assert [(r.path.rpartition("/")[2], r.error) for r in gone] == [("x.parquet", None)]
    assert not pathlib.Path(folder, "tickloom/compact-1/x.parquet").exists()
    assert pathlib.Path(folder, "other/y.parquet").exists()


def test_serving_update_and_reload(spark, zone, lake, folder, monkeypatch):
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    table = f"{folder}/serving"
    summary = spark.read.parquet(lake.summary)
    summary.withColumn("GroupVolume", F.lit(0).cast("bigint")).write.parquet(table)

    def refresh(df, *_, **__):
        df.write.mode("overwrite").parquet(table)

    monkeypatch.setattr(serving, "read_whole_serving", lambda *_, **__: spark.read.parquet(table))
    monkeypatch.setattr(serving, "serving_exists", lambda *_, **__: True)
    monkeypatch.setattr(serving, "refresh_serving", refresh)
    monkeypatch.setattr(ranges, "refresh_serving", refresh)
    ranges.update_serving(spark, lake, [MONDAY], url="jdbc:x", table="t")
    assert {r.GroupVolume for r in spark.read.parquet(table).collect()} == {0, 2}
    ranges.reload_serving(spark, lake, url="jdbc:x", table="t")
    assert {r.GroupVolume for r in spark.read.parquet(table).collect()} == {6, 5, 2}


def test_serving_table_is_made_on_first_use(spark, zone, lake, folder, monkeypatch):
    run_tick_load(spark, f"{zone}/raw", lake, days(spark))
    made = []
    monkeypatch.setattr(serving, "serving_exists", lambda *_, **__: False)
    monkeypatch.setattr(serving, "append_serving", lambda df, url, table, **_: made.append((table, df.count())))
    ranges.update_serving(spark, lake, [FRIDAY, MONDAY], url="jdbc:x", table="t")
    assert made == [("t", 3)]


def test_command_line(spark, zone, lake, capsys):
    config = zone.put("t.ini", f"[storage]\nraw = {zone}/raw\nlake = {lake.root}\n")

    def run(*argv, code=0):
        assert cli.main([*argv, "--config", config], spark) == code
        return capsys.readouterr()

    span = ["--start-date", str(FRIDAY), "--end-date", str(TUESDAY)]
    assert "2026-05-29" in run("land", "--date", str(FRIDAY)).out
    assert "failed" in run("land", "--date", str(MONDAY), code=1).out
    shown = run("ticks", *span, "--csv", code=1)
    assert read_summary_csv(spark, lake.summary_csv).count() == 3
    assert "ticks: 5 rows on 2 dates, 1 rejected" in shown.out
    assert "skipped" in shown.err
    assert "cancels: 2 rows on 1 dates" in run("cancels", *span).out
    assert "ticks: 5 rows" in run("backfill", *span, "--skip-ingestion", code=1).out
    assert "0 dates compacted" in run("maintain").out
    assert volumes(spark, lake) == EXPECTED


def test_command_line_defaults():
    args = cli.parser().parse_args(["backfill"])
    assert (args.start_date, args.end_date) == ("2026-03-01", "2026-04-30")
    with pytest.raises(SystemExit):
        cli.main(["maintain", "--config", "/nonexistent.ini"], object())
