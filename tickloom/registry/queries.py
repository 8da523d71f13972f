"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Queries about files write their input below the shared folder first and return
what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import samples
from tickloom.functions import cells
from tickloom.functions.days import business_days
from tickloom.operators import clean, levels, panels, rollup, runs, symbolsets
from tickloom.operators.replace import on_days, touched_dates
from tickloom.plans import daily
from tickloom.schemas import DATE_KEY, RAW_TICK_COLUMNS, SUMMARY, TICKS
from tickloom.session import fresh_dir
from tickloom.sinks import serving, tables, upkeep
from tickloom.sources import archives, delimited, files, rawzone
from tickloom.sources.tables import read_summary_csv, read_table
from tickloom.streaming import loads, partials

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}

# Dashboard choices used by the queries that show the filters.
CHOSEN = panels.Selection(
    message_codes=["click", "purchase"], first=dt.date(2024, 1, 8), last=dt.date(2024, 1, 21)
)
AS_OF = dt.datetime(2024, 1, 31)
CORRECTION_FROM = dt.date(2024, 1, 25)


def registered(query: Query) -> Query:
    _queries[query.__name__] = query
    return query


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.tick_summary(samples.ticks(spark, sf_dir))


# Cleaning


@registered
def ticks_clean(spark, sf_dir):
    return clean.clean_ticks(samples.raw_ticks(spark, sf_dir))


@registered
def tick_header_drop(spark, sf_dir):
    """Repeated header lines and rows without a key, mixed into the data."""
    raw = samples.raw_ticks(spark, sf_dir)
    headers = raw.where("Msg_Code = 'signup'").select(*[F.lit(c).alias(c) for c in raw.columns])
    keyless = raw.where("Msg_Code = 'view'").withColumn("Comm", F.lit(None).cast("string"))
    return clean.clean_ticks(raw.unionByName(headers).unionByName(keyless))


@registered
def ticks_lenient(spark, sf_dir):
    """Bad cells become null; rows without a date are kept out."""
    return clean.dated(clean.clean_ticks(samples.flawed_ticks(spark, sf_dir)))


@registered
def tick_rejects(spark, sf_dir):
    rejects = clean.reject_ticks(samples.flawed_ticks(spark, sf_dir))
    return rejects.withColumn("reasons", F.concat_ws("|", "reasons"))


@registered
def hour_bucket(spark, sf_dir):
    """Hours of clock texts: with colons, unpadded digits, too short, too long."""
    clock = samples.ticks(spark, sf_dir).select(F.col("TradeTime").alias("t"))
    digits = F.replace("t", F.lit(":"), F.lit(""))
    forms = F.array(
        F.col("t"), F.regexp_replace("t", "^0", ""), F.regexp_replace(digits, "^0+", ""),
        F.substring(digits, 1, 3), F.concat(digits, F.lit("99")), F.lit(None).cast("string"),
    )
    return (
        clock.select(F.posexplode(forms).alias("form", "clock"))
        .groupBy("form", cells.hour_bucket("clock").alias("hour")).agg(F.count("*").alias("n"))
    )


@registered
def cancels_clean(spark, sf_dir):
    return clean.clean_cancels(samples.raw_cancels(spark, sf_dir))


@registered
def cancel_rejects(spark, sf_dir):
    raw = samples.raw_cancels(spark, sf_dir).withColumn(
        "Price", F.when(F.col("Amend_Code") == "P", F.concat("Price", F.lit("-"))).otherwise(F.col("Price"))
    )
    rejects = clean.reject_cancels(raw)
    return rejects.withColumn("reasons", F.concat_ws("|", "reasons"))


# Roll-up and panels


@registered
def tick_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@registered
def tick_summary_scale(spark, sf_dir):
    return rollup.tick_summary(samples.ticks_from_lineitem(spark, sf_dir))


@registered
def reaggregation(spark, sf_dir):
    """Per date and symbol from the hourly summary; equal to a direct aggregate of ticks."""
    return rollup.coarser(_summary(spark, sf_dir), DATE_KEY, "Symbol")


@registered
def summary_profile(spark, sf_dir):
    return panels.table_profile(_summary(spark, sf_dir))


@registered
def symbol_volume(spark, sf_dir):
    return panels.symbol_volume(_summary(spark, sf_dir))


@registered
def summary_sample(spark, sf_dir):
    return panels.sample_rows(_summary(spark, sf_dir))


@registered
def symbol_values(spark, sf_dir):
    return panels.choices(_summary(spark, sf_dir), "Symbol")


@registered
def message_code_values(spark, sf_dir):
    return panels.choices(_summary(spark, sf_dir), "MessageCode")


@registered
def total_volume(spark, sf_dir):
    return panels.total_volume(_summary(spark, sf_dir))


@registered
def total_ticks(spark, sf_dir):
    return panels.total_ticks(_summary(spark, sf_dir))


@registered
def total_volume_chosen(spark, sf_dir):
    return panels.total_volume(_summary(spark, sf_dir), CHOSEN)


@registered
def vwap_series(spark, sf_dir):
    return panels.vwap_series(_summary(spark, sf_dir))


@registered
def vwap_series_scale(spark, sf_dir):
    return panels.vwap_series(rollup.tick_summary(samples.ticks_from_lineitem(spark, sf_dir)))


@registered
def vwap_series_chosen(spark, sf_dir):
    return panels.vwap_series(_summary(spark, sf_dir), CHOSEN)


@registered
def hourly_liquidity(spark, sf_dir):
    return panels.hourly_liquidity(_summary(spark, sf_dir))


@registered
def market_share(spark, sf_dir):
    return panels.with_share(panels.market_share(_summary(spark, sf_dir), as_of=AS_OF))


@registered
def trade_detail_500(spark, sf_dir):
    return panels.trade_detail(_summary(spark, sf_dir))


@registered
def mean_price(spark, sf_dir):
    return panels.mean_prices(_summary(spark, sf_dir))


# Files and tables


@registered
def delimited_ticks(spark, sf_dir):
    """Comma-separated files whose columns come in two different orders."""
    raw = samples.raw_ticks(spark, sf_dir)
    root = fresh_dir(spark, "delimited")
    samples.write_delimited(raw.where("Msg_Code <> 'click'"), f"{root}/a")
    turned = raw.where("Msg_Code = 'click'").select(F.lit("x").alias("Extra"), *raw.columns[::-1])
    samples.write_delimited(turned, f"{root}/b")
    return clean.clean_ticks(delimited.read_ticks(spark, root))


@registered
def delimited_cancels(spark, sf_dir):
    """Tab-separated files."""
    root = fresh_dir(spark, "cancels")
    samples.write_delimited(samples.raw_cancels(spark, sf_dir), root, "\t")
    return clean.clean_cancels(delimited.read_cancels(spark, root, "*.csv"))


@registered
def zip_ticks(spark, sf_dir):
    """One archive per day, read without unpacking to disk."""
    root = fresh_dir(spark, "zips")
    samples.write_raw_zone(samples.raw_ticks(spark, sf_dir), root)
    read = archives.read_zipped_ticks(files.list_files(spark, f"{root}/raw", "*.zip"))
    return clean.clean_ticks(read.rows)


@registered
def daily_load(spark, sf_dir):
    """Raw archives of all weekdays through the whole tick load; returns the summary."""
    root = fresh_dir(spark, "daily")
    samples.write_raw_zone(samples.raw_ticks(spark, sf_dir), root)
    bounds = samples.ticks(spark, sf_dir).agg(
        F.min(DATE_KEY).alias("first"), F.max(DATE_KEY).alias("last")
    )
    lake = daily.Lake(f"{root}/lake")
    daily.run_tick_load(spark, f"{root}/raw", lake, runs.weekdays_between(bounds))
    return spark.read.parquet(lake.summary).select(*_summary(spark, sf_dir).columns)


@registered
def quarantine(spark, sf_dir):
    """Rejects written by the tick load."""
    lake = daily.Lake(fresh_dir(spark, "quarantine"))
    daily.load_ticks(samples.flawed_ticks(spark, sf_dir), lake, "first")
    return _rejects(spark, lake.rejects("ticks"))


def _rejects(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path).select(*RAW_TICK_COLUMNS, "reasons")
    return rows.withColumn("reasons", F.concat_ws("|", "reasons"))


def _zone(spark: SparkSession, name: str) -> tuple[str, daily.Lake]:
    root = fresh_dir(spark, name)
    return root, daily.Lake(f"{root}/lake")


def _archives(spark: SparkSession, root: str) -> DataFrame:
    return files.list_files(spark, f"{root}/raw", "*.zip")


def _published(spark: SparkSession, lake: daily.Lake) -> DataFrame:
    return spark.read.parquet(lake.summary).select(*SUMMARY.fieldNames())


def _late(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("Trade_Date") >= F.lit(CORRECTION_FROM.strftime("%Y%m%d")))


@registered
def stray_date_load(spark, sf_dir):
    """The last days are delivered again, with rows of an earlier day in their files."""
    root, lake = _zone(spark, "stray")
    raw = samples.raw_ticks(spark, sf_dir)
    samples.write_raw_zone(raw, root)
    daily.load_archives(spark, _archives(spark, root), lake)
    strays = raw.where("Trade_Date = '20240103'").withColumn("Volume", F.lit("999"))
    file_day = F.greatest("Trade_Date", F.lit("20240125"))
    samples.write_raw_zone(_late(raw).unionByName(strays), f"{root}/again", file_day)
    daily.load_archives(spark, _archives(spark, f"{root}/again"), lake)
    return _published(spark, lake)


@registered
def damaged_part_load(spark, sf_dir):
    """The last days are delivered again in two archives each, one of them damaged: they stay as they were."""
    root, lake = _zone(spark, "damaged")
    raw = samples.raw_ticks(spark, sf_dir)
    samples.write_raw_zone(raw, root)
    daily.load_archives(spark, _archives(spark, root), lake)
    again = _late(raw).withColumn("Volume", F.lit("999"))
    samples.write_raw_zone(again, f"{root}/again")
    samples.write_day_files(again.select(F.col("Trade_Date").alias("day")), f"{root}/again", b"broken", "more")
    daily.load_archives(spark, _archives(spark, f"{root}/again"), lake)
    return _published(spark, lake)


@registered
def emptied_day_load(spark, sf_dir):
    """The last days are delivered again without any row."""
    root, lake = _zone(spark, "emptied")
    raw = samples.raw_ticks(spark, sf_dir)
    samples.write_raw_zone(raw, root)
    daily.load_archives(spark, _archives(spark, root), lake)
    days = _late(raw).select(F.col("Trade_Date").alias("day"))
    samples.write_day_files(days, f"{root}/again", samples.header_only_archive(), "empty")
    daily.load_archives(spark, _archives(spark, f"{root}/again"), lake)
    return _published(spark, lake)


@registered
def quarantine_reload(spark, sf_dir):
    """Archives with bad cells are loaded all together, and some days once more: rejects do not double."""
    root, lake = _zone(spark, "reload")
    flawed = samples.flawed_ticks(spark, sf_dir)
    # A row without a usable date lies in the file of some day of its month.
    day = F.when(F.col("Trade_Date") == "abc", F.lit("20240103")).otherwise(F.col("Trade_Date"))
    samples.write_raw_zone(flawed, root, day)
    listing = _archives(spark, root)
    daily.load_archives(spark, listing, lake)
    daily.load_archives(spark, listing.where("path LIKE '%/2024010%'"), lake)
    return _rejects(spark, lake.rejects("ticks"))


@registered
def load_balance(spark, sf_dir):
    """Lines of each day's file by what became of them; they add up to the lines read.

    Among the lines are bad cells, repeated headers, lines without a symbol, and some of another date.
    """
    root, lake = _zone(spark, "balance")
    raw = samples.raw_ticks(spark, sf_dir)
    headers = raw.where("Msg_Code = 'signup'").select(*[F.lit(c).alias(c) for c in raw.columns])
    keyless = raw.where("Msg_Code = 'view'").withColumn("Comm", F.lit(None).cast("string"))
    day = F.col("Trade_Date")
    strayed = (day == "20240105") & (F.col("Msg_Code") == "purchase")
    file_day = (
        F.when(day == "abc", "20240103").when(day == "Trade_Date", "20240104").when(strayed, "20240108").otherwise(day)
    )
    mixed = samples.flawed_ticks(spark, sf_dir).unionByName(headers).unionByName(keyless)
    samples.write_raw_zone(mixed, root, file_day)
    daily.load_archives(spark, _archives(spark, root), lake)
    counts = ["lines", *clean.OUTCOMES]
    return spark.read.parquet(lake.totals).groupBy("file_day").agg(*[F.sum(c).alias(c) for c in counts])


@registered
def daily_load_csv(spark, sf_dir):
    """The summary that a load writes as text."""
    root, lake = _zone(spark, "daily-csv")
    samples.write_raw_zone(samples.raw_ticks(spark, sf_dir), root)
    bounds = samples.ticks(spark, sf_dir).agg(F.min(DATE_KEY).alias("first"), F.max(DATE_KEY).alias("last"))
    daily.run_tick_load(spark, f"{root}/raw", lake, runs.weekdays_between(bounds), as_csv=True)
    return read_summary_csv(spark, lake.summary_csv)


@registered
def vwap_sql(spark, sf_dir):
    """The hourly price series as SQL over the published tables."""
    _, lake = _zone(spark, "vwap-sql")
    daily.load_ticks(samples.raw_ticks(spark, sf_dir), lake, "all")
    daily.register_views(spark, lake)
    return spark.sql("""
        SELECT market_time(TradeDateParsed, Hour) AS time,
               weighted_price(sum(GroupPriceVolume), sum(GroupVolume)) AS `Weighted Avg Price`,
               sum(GroupVolume) AS Volume
        FROM ticks_summary WHERE TradeDateParsed IS NOT NULL AND Symbol IS NOT NULL AND MessageCode IS NOT NULL
        GROUP BY market_time(TradeDateParsed, Hour)
    """)


@registered
def symbols_chosen(spark, sf_dir):
    """Volume by hour of chosen symbols; an empty choice of codes is all of them."""
    chosen = panels.Selection(symbols=["U1", "U2", "U3"], message_codes=[])
    return panels.hourly_liquidity(_summary(spark, sf_dir), chosen)


@registered
def csv_round_trip(spark, sf_dir):
    path = fresh_dir(spark, "summary-csv")
    tables.write_csv(_summary(spark, sf_dir), path)
    return read_summary_csv(spark, path)


def _corrected(ticks: DataFrame) -> DataFrame:
    """Corrected ticks of the last days: one more unit of volume each."""
    return ticks.where(F.col(DATE_KEY) >= F.lit(CORRECTION_FROM)).withColumn(
        "TradeVolume", F.col("TradeVolume") + 1
    )


@registered
def partition_replace(spark, sf_dir):
    """Corrected days replace their partitions, twice, and leave the others alone."""
    ticks = samples.ticks(spark, sf_dir)
    path = fresh_dir(spark, "replace")
    tables.write_table(ticks, path)
    for _ in range(2):
        tables.write_table(_corrected(ticks), path)
    return rollup.tick_summary(spark.read.parquet(path))


@registered
def serving_replace(spark, sf_dir):
    """The replacement a serving table gets, staged, on the summary."""
    ticks = samples.ticks(spark, sf_dir)
    batch = rollup.tick_summary(_corrected(ticks))
    return serving.staged_replacement(rollup.tick_summary(ticks), batch)


@registered
def batch_dates(spark, sf_dir):
    """Dates a batch touches."""
    return touched_dates(samples.ticks_from_lineitem(spark, sf_dir))


@registered
def compaction(spark, sf_dir):
    """Many small files per date, compacted; the rows stay the same."""
    path = fresh_dir(spark, "compaction")
    summary = _summary(spark, sf_dir)
    scattered = summary.repartition(4)
    scattered.write.partitionBy(DATE_KEY).parquet(path)
    upkeep.compact(spark, path)
    return spark.read.parquet(path).select(*summary.columns)


@registered
def clustered_compaction(spark, sf_dir):
    """Many small files per date, clustered by symbol; the rows stay the same."""
    path = fresh_dir(spark, "clustered")
    summary = _summary(spark, sf_dir)
    summary.repartition(4).write.partitionBy(DATE_KEY).parquet(path)
    upkeep.cluster(spark, path, levels.all_dates(summary), ["Symbol", "MessageCode", "Hour"])
    return spark.read.parquet(path).select(*summary.columns)


# Date ranges that cut months at one or both ends, lie in a month, or are made of whole ones.
RANGES = [
    (dt.date(2024, 1, 10), dt.date(2024, 3, 17)), (dt.date(2024, 2, 5), dt.date(2024, 2, 20)),
    (dt.date(2024, 2, 1), dt.date(2024, 3, 31)), (dt.date(2023, 1, 1), dt.date(2025, 12, 31)),
]


@registered
def total_volume_range(spark, sf_dir):
    """Total volume of date ranges from whole months and edge days, after a correction of some days."""
    root = fresh_dir(spark, "levels")
    ticks = samples.ticks_of_months(spark, sf_dir)
    made = levels.Levels(root)
    tables.write_table(rollup.tick_summary(ticks), f"{root}/summary")
    levels.refresh_levels(spark, f"{root}/summary", made, levels.all_dates(ticks))
    corrected = ticks.where(f"{DATE_KEY} BETWEEN '2024-02-10' AND '2024-02-12'").withColumn(
        "TradeVolume", F.col("TradeVolume") + 1
    )
    tables.write_table(rollup.tick_summary(corrected), f"{root}/summary")
    levels.refresh_levels(spark, f"{root}/summary", made, levels.all_dates(corrected))
    totals = [
        levels.total_volume_range(spark, made, *ends).select(
            F.lit(ends[0]).alias("first_day"), F.lit(ends[1]).alias("last_day"), "Total Volume"
        )
        for ends in RANGES
    ]
    return reduce(DataFrame.unionByName, totals)


@registered
def summary_of_picked_days(spark, sf_dir):
    """Summary of the days on which purchases outweigh clicks; the day level picks them at run time."""
    root = fresh_dir(spark, "picked-days")
    summary, made = _summary(spark, sf_dir), levels.Levels(root)
    tables.write_table(summary, f"{root}/summary")
    levels.refresh_levels(spark, f"{root}/summary", made, levels.all_dates(summary))
    volume = {code: F.sum(F.when(F.col("MessageCode") == code, F.col("GroupVolume"))) for code in ("purchase", "click")}
    days = read_table(spark, made.days).groupBy(DATE_KEY).agg(*[v.alias(code) for code, v in volume.items()])
    return on_days(read_table(spark, f"{root}/summary"), days.where("purchase > click"))


@registered
def distinct_symbols_range(spark, sf_dir):
    """Different symbols of date ranges from bitmaps kept per date, in two loads."""
    root = fresh_dir(spark, "symbol-sets")
    summary = _summary(spark, sf_dir)
    for part in (f"{DATE_KEY} < '2024-01-16'", f"{DATE_KEY} >= '2024-01-16'"):
        symbolsets.refresh_sets(summary.where(part), root)
    counts = []
    for first, last in ((1, 1), (3, 9), (14, 18), (1, 31)):
        days = [dt.date(2024, 1, day) for day in range(first, last + 1)]
        found = symbolsets.distinct_symbols(spark, root, days)
        counts.append(found.select(F.lit(days[0]).alias("first_day"), F.lit(days[-1]).alias("last_day"), "symbols"))
    return reduce(DataFrame.unionByName, counts)


@registered
def retention_candidates(spark, sf_dir):
    """Files of a replaced version of the summary, by date; those of the first days are past the retention."""
    root = fresh_dir(spark, "retention")
    summary = _summary(spark, sf_dir)
    tables.write_table(summary, f"{root}/v1")
    tables.write_table(summary, f"{root}/v2")
    day = F.regexp_extract("path", f"/{DATE_KEY}=([^/]+)/", 1).cast("date")
    written = F.col("modificationTime")
    aged = F.when(day < F.lit("2024-01-16").cast("date"), written - F.expr("interval 169 hours")).otherwise(written)
    listing = files.list_files(spark, root, "*.parquet").withColumn("modificationTime", aged)
    live = files.list_files(spark, f"{root}/v2", "*.parquet")
    old = upkeep.retention_candidates(listing, live, dt.datetime.now())
    version = F.regexp_extract("path", "/(v[12])/", 1)
    return old.select(version.alias("version"), day.alias(DATE_KEY)).distinct()


# Calendar, raw zone and run state


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.weekdays_between(samples.order_bounds(spark, sf_dir))


@registered
def business_calendar(spark, sf_dir):
    return _order_days(spark, sf_dir)


@registered
def business_day_count(spark, sf_dir):
    """Signed business days from each order's date to another day around it."""
    start = F.to_date("o_orderdate")
    orders = samples.table(spark, sf_dir, "orders").select(
        "o_orderkey", start.alias("a"),
        F.date_add(start, (F.col("o_custkey") % 61 - 30).cast("int")).alias("b"),
    )
    return orders.select(
        "o_orderkey",
        business_days(F.col("a"), F.col("b")).alias("both_ends"),
        business_days(F.col("a"), F.col("b"), inclusive=False).alias("one_end"),
    )


@registered
def raw_completeness(spark, sf_dir):
    return rawzone.completeness(samples.raw_listing(spark, sf_dir))


@registered
def days_ready(spark, sf_dir):
    complete = rawzone.completeness(samples.raw_listing(spark, sf_dir))
    return rawzone.days_with(_order_days(spark, sf_dir), complete)


@registered
def days_to_fetch(spark, sf_dir):
    complete = rawzone.completeness(samples.raw_listing(spark, sf_dir))
    return rawzone.days_missing(_order_days(spark, sf_dir), complete)


@registered
def landing_manifest(spark, sf_dir):
    return rawzone.landing_manifest(
        _order_days(spark, sf_dir), samples.raw_listing(spark, sf_dir)
    )


@registered
def feed_id_resolution(spark, sf_dir):
    return runs.resolve_feed_ids(_order_days(spark, sf_dir), samples.probes(spark, sf_dir))


def _current_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_runs(samples.run_log(spark, sf_dir))


def _clock(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@registered
def run_log_latest(spark, sf_dir):
    """Log entries appended in two writes, then the current state per day."""
    path = fresh_dir(spark, "runs")
    log = samples.run_log(spark, sf_dir)
    tables.append_runs(log.where("status <> 'running'"), path)
    tables.append_runs(log.where("status = 'running'"), path)
    current = runs.latest_runs(spark.read.parquet(path))
    return current.select("job_date", "status", _clock("started_at"), _clock("ended_at"), "results")


@registered
def run_report(spark, sf_dir):
    return runs.run_report(samples.run_log(spark, sf_dir)).withColumn(
        "started_at", _clock("started_at")
    )


@registered
def run_outcome(spark, sf_dir):
    log = runs.run_outcome(samples.run_log(spark, sf_dir))
    return log.groupBy("status", "outcome").agg(F.count("*").alias("run_count"))


@registered
def outcome_report(spark, sf_dir):
    return runs.outcome_report(_current_runs(spark, sf_dir))


@registered
def backfill_plan(spark, sf_dir):
    current = _current_runs(spark, sf_dir).withColumn("job_date", F.col("job_date").cast("date"))
    complete = rawzone.completeness(samples.raw_listing(spark, sf_dir))
    return runs.backfill_plan(_order_days(spark, sf_dir), complete, current)


# Streaming


@registered
def incremental_load(spark, sf_dir):
    """Files arrive in two waves; each start loads the new ones, a third start none."""
    root = fresh_dir(spark, "incremental")
    raw = samples.raw_ticks(spark, sf_dir)
    waves = [raw.where("Trade_Date < '20240116'"), raw.where("Trade_Date >= '20240116'"), None]
    for n, wave in enumerate(waves):
        if wave is not None:
            samples.write_delimited(wave, f"{root}/in/wave{n}")
        stream = loads.tick_stream(spark, f"{root}/in")
        query = loads.load_new_files(stream, f"{root}/out", f"{root}/rejects", f"{root}/checkpoint")
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*TICKS.fieldNames())


@registered
def incremental_rejects(spark, sf_dir):
    """Rejects of files with bad cells that arrive in two waves."""
    root = fresh_dir(spark, "incremental-rejects")
    flawed = samples.flawed_ticks(spark, sf_dir)
    for n, wave in enumerate(["Msg_Code < 'n'", "Msg_Code >= 'n'"]):
        samples.write_delimited(flawed.where(wave), f"{root}/in/wave{n}")
        stream = loads.tick_stream(spark, f"{root}/in")
        query = loads.load_new_files(stream, f"{root}/out", f"{root}/rejects", f"{root}/checkpoint")
        query.awaitTermination()
    return _rejects(spark, f"{root}/rejects")


@registered
def split_day_stream(spark, sf_dir):
    """Each day comes in two archives, in different deliveries and batches."""
    root, lake = _zone(spark, "split-days")
    raw = samples.raw_ticks(spark, sf_dir)
    for n, part in enumerate(["Volume % 2 = 0", "Volume % 2 = 1"]):
        samples.write_raw_zone(raw.where(part), root, delivery=f"d{n}")
        stream = loads.archive_stream(spark, f"{root}/raw", per_batch=16)
        loads.replace_days_from_archives(stream, lake, f"{root}/checkpoint").awaitTermination()
    return _published(spark, lake)


@registered
def stream_replace(spark, sf_dir):
    """A second delivery corrects the last days; ticks and summary follow."""
    root = fresh_dir(spark, "stream-replace")
    raw = samples.raw_ticks(spark, sf_dir)
    fixed = raw.where("Trade_Date >= '20240125'").withColumn(
        "Volume", (F.col("Volume").cast("int") + 1).cast("string")
    )
    lake = daily.Lake(f"{root}/lake")
    for n, delivery in enumerate([raw, fixed]):
        samples.write_delimited(delivery, f"{root}/in/delivery{n}")
        stream = loads.tick_stream(spark, f"{root}/in")
        loads.replace_days(stream, lake, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(lake.summary).select(*_summary(spark, sf_dir).columns)


@registered
def stream_archives(spark, sf_dir):
    """Archives of new days arrive in two deliveries; each start loads the new ones."""
    root = fresh_dir(spark, "stream-archives")
    raw = samples.raw_ticks(spark, sf_dir)
    lake = daily.Lake(f"{root}/lake")
    for n, part in enumerate(["Trade_Date < '20240116'", "Trade_Date >= '20240116'"]):
        samples.write_raw_zone(raw.where(part), f"{root}/in/delivery{n}")
        stream = loads.archive_stream(spark, f"{root}/in")
        loads.replace_days_from_archives(stream, lake, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(lake.summary).select(*_summary(spark, sf_dir).columns)


@registered
def stream_hourly_corrected(spark, sf_dir):
    """Two waves, the second with ticks that are late for every hour: the summary is that of all ticks."""
    root = fresh_dir(spark, "stream-corrected")
    ticks = samples.ticks(spark, sf_dir)
    for n, wave in enumerate(["TradeVolume % 3 <> 1", "TradeVolume % 3 = 1"]):
        ticks.where(wave).write.parquet(f"{root}/in/wave{n}")
        reader = spark.readStream.schema(ticks.schema).option("recursiveFileLookup", True)
        partials.correct_hours(
            reader.parquet(f"{root}/in"), f"{root}/partials", f"{root}/summary", f"{root}/checkpoint"
        ).awaitTermination()
    return spark.read.parquet(f"{root}/summary").select(*SUMMARY.fieldNames())


@registered
def stream_hourly(spark, sf_dir):
    """Hours closed by the watermark, from a stream of tick files."""
    root = fresh_dir(spark, "stream-hourly")
    ticks = samples.ticks(spark, sf_dir)
    ticks.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(ticks.schema).parquet(f"{root}/in")
    query = (
        loads.hourly_summary(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
        .start(f"{root}/out")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out")
