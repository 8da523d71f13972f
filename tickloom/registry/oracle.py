"""The same queries as SQL over the test tables, for an independent engine."""

from __future__ import annotations

_TICKS = """
ticks AS (
  SELECT 'U' || user_id AS "Symbol", event_type AS "MessageCode",
         cast(ts AS date) AS "TradeDateParsed", strftime(ts, '%H:%M:%S') AS "TradeTime",
         cast(value AS decimal(18,4)) AS "TradePrice",
         cast(json_extract_string(props, '$.k') AS int) AS "TradeVolume"
  FROM events)"""

_SCALE_TICKS = """
ticks AS (
  SELECT 'P' || l_partkey AS "Symbol", l_returnflag AS "MessageCode",
         cast(l_shipdate AS date) AS "TradeDateParsed",
         cast((l_orderkey % 24) * 10000 + l_linenumber * 100 AS varchar) AS "TradeTime",
         cast(l_extendedprice AS decimal(18,4)) AS "TradePrice",
         cast(l_quantity AS int) AS "TradeVolume"
  FROM lineitem)"""

_CORRECTED = """
corrected AS (
  SELECT * REPLACE ("TradeVolume" + CASE WHEN "TradeDateParsed" >= DATE '2024-01-25'
                                         THEN 1 ELSE 0 END AS "TradeVolume")
  FROM ticks)"""


def _hour(clock: str) -> str:
    return f"substr(lpad(replace({clock}, ':', ''), 6, '0'), 1, 2)"


_MEASURES = """
         cast(sum("TradeVolume") AS bigint) AS "GroupVolume",
         count(*) AS "GroupTradeCount",
         cast(sum("TradePrice" * "TradeVolume") AS decimal(38,4)) AS "GroupPriceVolume",
         cast(sum("TradePrice") AS decimal(28,4)) AS "GroupPriceSum\""""


def _summary_of(ticks: str) -> str:
    return f"""
  SELECT "TradeDateParsed", "Symbol", "MessageCode", {_hour('"TradeTime"')} AS "Hour",
{_MEASURES}
  FROM {ticks} GROUP BY ALL"""


def _over_summary(body: str, ticks: str = _TICKS) -> str:
    return f"WITH {ticks}, summary AS ({_summary_of('ticks')}) {body}"


def _ratio(amount: str, units: str) -> str:
    """Half-up quotient to four decimals by whole numbers (no negative inputs)."""
    return (
        f"cast(cast((2 * cast({amount} * 10000 AS hugeint) + {units}) // nullif(2 * {units}, 0)"
        f" AS decimal(22,0)) * 0.0001 AS decimal(22,4))"
    )


_CLEAN_COLUMNS = """
         'U' || user_id AS "Symbol", 'F' AS "ContractType",
         substr('FGHJKMNQUVXZ', cast(month(ts) AS int), 1) AS "MonthCode",
         cast(year(ts) AS varchar) AS "DeliveryYear", '0' AS "StrikePrice",
         strftime(ts, '%H:%M:%S') AS "TradeTime", event_type AS "MessageCode"
"""

_TICKS_CLEAN = f"""
  SELECT {_CLEAN_COLUMNS}, cast(ts AS date) AS "TradeDateParsed",
         cast(value AS decimal(18,4)) AS "TradePrice",
         cast(json_extract_string(props, '$.k') AS int) AS "TradeVolume",
         cast(year(ts) AS int) AS "year", cast(month(ts) AS int) AS "month"
  FROM events"""

_FLAWED = """
flawed AS (
  SELECT ' U' || user_id || ' ' AS "Comm", 'F' AS "Contract_Type",
         substr('FGHJKMNQUVXZ', cast(month(ts) AS int), 1) AS "Mth_Code",
         cast(year(ts) AS varchar) AS "Year", '0' AS "Strike",
         strftime(ts, '%H:%M:%S') AS "Log_Time", event_type AS "Msg_Code",
         CASE WHEN hour(ts) = 0 THEN 'abc' ELSE strftime(ts, '%Y%m%d') END AS "Trade_Date",
         cast(cast(value AS decimal(18,4)) AS varchar)
           || CASE WHEN event_type = 'error' THEN '?' ELSE '' END AS "Price",
         CASE WHEN json_extract_string(props, '$.k') = '0' THEN '0.5'
              ELSE json_extract_string(props, '$.k') END AS "Volume"
  FROM events)"""

_TICK_REJECTS = f"""
WITH {_FLAWED}, judged AS (
  SELECT *, concat_ws('|',
           CASE WHEN "Trade_Date" = 'abc' THEN 'Trade_Date' END,
           CASE WHEN try_cast("Price" AS decimal(18,4)) IS NULL THEN 'Price' END,
           CASE WHEN NOT regexp_full_match("Volume", '[0-9]+') THEN 'Volume' END,
           CASE WHEN "Trade_Date" = 'abc' THEN 'no trade date' END) AS reasons
  FROM flawed)
SELECT * FROM judged WHERE reasons <> ''"""

_CANCELS = """
cancels AS (
  SELECT cast(o_custkey AS varchar) || '  ' AS "Commodity", 'F' AS "Contract_Type",
         substr('FGHJKMNQUVXZ', cast(month(o_orderdate) AS int), 1) AS "Delivery_Month",
         cast(year(o_orderdate) AS varchar) AS "Delivery_Year", '0' AS "Strike_Price",
         strftime(o_orderdate, '%Y%m%d') AS "Business_Date",
         cast((o_orderkey % 24) * 10000 AS varchar) AS "Match_Time",
         substr(o_orderpriority, 1, 1) AS "Price_Indicator", 'C' AS "Message_Code",
         o_orderstatus AS "Amend_Code",
         cast(cast(o_totalprice AS decimal(18,4)) AS varchar) AS "Price",
         cast(o_custkey % 100 AS varchar) AS "Volume"
  FROM orders)"""

_CANCELS_CLEAN = f"""
WITH {_CANCELS}
SELECT trim("Commodity", ' ') AS "Symbol", "Contract_Type" AS "ContractType",
       "Delivery_Month" AS "DeliveryMonth", "Delivery_Year" AS "DeliveryYear",
       "Strike_Price" AS "StrikePrice", "Business_Date" AS "TradeDate",
       "Match_Time" AS "CancelTime", "Price_Indicator" AS "PriceIndicator",
       "Message_Code" AS "MessageCode", "Amend_Code" AS "AmendCode",
       cast(strptime("Business_Date", '%Y%m%d') AS date) AS "TradeDateParsed",
       cast(cast("Price" AS decimal(18,4)) AS double) / 100.0::double AS "Price",
       cast("Volume" AS int) AS "Volume",
       cast(substr("Business_Date", 1, 4) AS int) AS "year",
       cast(substr("Business_Date", 5, 2) AS int) AS "month"
FROM cancels"""

_CHOSEN = """"MessageCode" IN ('click', 'purchase')
  AND "TradeDateParsed" BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""


def _vwap(where: str = "true") -> str:
    return f"""
SELECT cast("TradeDateParsed" AS timestamp) + to_hours(cast("Hour" AS int)) AS "time",
       {_ratio('sum("GroupPriceVolume")', 'cast(sum("GroupVolume") AS hugeint)')}
         AS "Weighted Avg Price",
       cast(sum("GroupVolume") AS bigint) AS "Volume"
FROM summary WHERE {where} GROUP BY 1"""


_DAYS = """
days AS (
  SELECT cast(d AS date) AS job_date
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
        FROM orders)
  WHERE isodow(d) < 6)"""

_COMPLETE = """
complete AS (
  SELECT job_date, bool_or(is_tick) AS has_ticks, bool_or(NOT is_tick) AS has_cancels,
         bool_or(is_tick) AND bool_or(NOT is_tick) AS complete
  FROM (SELECT cast(l_shipdate AS date) AS job_date, true AS is_tick FROM lineitem
        UNION ALL
        SELECT cast(o_orderdate AS date), false FROM orders WHERE day(o_orderdate) < 28)
  GROUP BY 1)"""

_LOG = """
attempts AS (
  SELECT *, strftime(o_orderdate, '%Y%m%d') AS k,
         CASE WHEN o_orderstatus = 'P' THEN 'running'
              WHEN o_orderpriority = '5-LOW' THEN 'skipped'
              WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'success' END AS status,
         o_orderdate + to_seconds(o_orderkey % 86400) AS started_at,
         o_orderpriority = '1-URGENT' OR o_orderkey % 7 = 0 AS missed
  FROM orders),
run_log AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS job_date, status, started_at,
         CASE WHEN status <> 'running' THEN started_at + INTERVAL 5 MINUTE END AS ended_at,
         CASE WHEN status = 'skipped' THEN 'Holiday or Weekend'
              WHEN status <> 'running' THEN
                '[{"filename":"WEBPXTICK_DT_' || k || '.zip","status":"success"},'
                || '{"filename":"TC_' || k || '.txt","status":'
                || CASE WHEN missed THEN '"timed out","error":"HTTP 504"}]'
                        ELSE '"success"}]' END
         END AS results, k, missed
  FROM attempts)"""

_LATEST = f"""{_LOG},
latest AS (
  SELECT * FROM run_log
  QUALIFY row_number() OVER (PARTITION BY job_date
    ORDER BY started_at DESC, ended_at DESC NULLS LAST, status DESC, results DESC NULLS LAST) = 1)"""

_WEEKDAYS = "len(list_filter(generate_series({0}, {1}, INTERVAL 1 DAY), lambda x: isodow(x) < 6))"


def _count_days(first: str, last: str, inclusive: bool) -> str:
    """Weekdays after ``first`` up to ``last``, counted day by day."""
    after = _WEEKDAYS.format(f"{first} + INTERVAL 1 DAY", last)
    return f"({after} + CASE WHEN isodow({first}) < 6 THEN {int(inclusive)} ELSE 0 END)"


def _signed(first: str, last: str, inclusive: bool) -> str:
    return (
        f"cast(CASE WHEN {first} = {last} THEN 0"
        f" WHEN {first} < {last} THEN {_count_days(first, last, inclusive)}"
        f" ELSE -{_count_days(last, first, inclusive)} END AS int)"
    )


_FEED_IDS = f"""
WITH {_DAYS},
probes AS (
  SELECT cast(o_orderdate AS date) AS job_date,
         date_diff('day', DATE '1995-01-01', cast(o_orderdate AS date)) + 1000 AS feed_id,
         o_orderstatus = 'P' AND month(o_orderdate) % 2 = 0 AS broken,
         o_orderstatus = 'F' AND day(o_orderdate) > 15 AS found
  FROM orders),
by_day AS (
  SELECT job_date, bool_or(broken) AS broken, bool_or(found AND NOT broken) AS found,
         min(feed_id) AS feed_id
  FROM probes GROUP BY 1)
SELECT job_date,
       CASE WHEN found THEN feed_id
            WHEN broken THEN 6211 + {_signed("DATE '2026-05-29'", "job_date", True)}
       END AS feed_id,
       CASE WHEN found THEN 'catalog' WHEN broken THEN 'estimate' ELSE 'holiday' END AS origin
FROM days LEFT JOIN by_day USING (job_date)"""

_STREAM_HOURLY = f"""
WITH {_TICKS},
timed AS (
  SELECT strptime(strftime("TradeDateParsed", '%Y%m%d') || "TradeTime", '%Y%m%d%H:%M:%S') AS moment
  FROM ticks),
closing AS (SELECT max(moment) - INTERVAL 10 MINUTE AS mark FROM timed),
hourly AS ({_summary_of('ticks')})
SELECT hourly.* FROM hourly, closing
WHERE cast("TradeDateParsed" AS timestamp) + to_hours(cast("Hour" AS int) + 1) <= mark"""

_LOAD_BALANCE = f"""
WITH {_FLAWED}, judged AS (
  SELECT "Msg_Code", "Trade_Date" AS day,
         CASE WHEN "Trade_Date" = 'abc' THEN 'undated'
              WHEN "Trade_Date" = '20240105' AND "Msg_Code" = 'purchase' THEN 'stray'
              WHEN try_cast("Price" AS decimal(18,4)) IS NULL OR NOT regexp_full_match("Volume", '[0-9]+')
              THEN 'repaired' ELSE 'clean' END AS outcome
  FROM flawed),
lines AS (
  SELECT CASE outcome WHEN 'undated' THEN '20240103' WHEN 'stray' THEN '20240108' ELSE day END AS day, outcome FROM judged
  UNION ALL SELECT '20240104', 'header' FROM events WHERE event_type = 'signup'
  UNION ALL SELECT strftime(ts, '%Y%m%d'), 'keyless' FROM events WHERE event_type = 'view')
SELECT cast(strptime(day, '%Y%m%d') AS date) AS file_day, count(*) AS lines,
       count(*) FILTER (outcome = 'clean') AS clean, count(*) FILTER (outcome = 'repaired') AS repaired,
       count(*) FILTER (outcome = 'stray') AS stray, count(*) FILTER (outcome = 'undated') AS undated,
       count(*) FILTER (outcome = 'keyless') AS keyless, count(*) FILTER (outcome = 'header') AS header
FROM lines GROUP BY 1"""

_RANGE_TOTALS = f"""
WITH {_TICKS}, moved AS (
  SELECT "TradeVolume" AS v, "TradeDateParsed" + cast("TradeVolume" % 4 * 30 AS int) AS d FROM ticks),
corrected AS (
  SELECT d, v + CASE WHEN d BETWEEN DATE '2024-02-10' AND DATE '2024-02-12' THEN 1 ELSE 0 END AS v FROM moved),
ranges AS (
  SELECT unnest([DATE '2024-01-10', DATE '2024-02-05', DATE '2024-02-01', DATE '2023-01-01']) AS first_day,
         unnest([DATE '2024-03-17', DATE '2024-02-20', DATE '2024-03-31', DATE '2025-12-31']) AS last_day)
SELECT first_day, last_day, cast(sum(v) AS bigint) AS "Total Volume"
FROM ranges LEFT JOIN corrected ON d BETWEEN first_day AND last_day GROUP BY ALL"""

_RANGE_SYMBOLS = f"""
WITH {_TICKS}, ranges AS (
  SELECT unnest([1, 3, 14, 1]) AS a, unnest([1, 9, 18, 31]) AS b)
SELECT DATE '2024-01-01' + cast(a - 1 AS int) AS first_day, DATE '2024-01-01' + cast(b - 1 AS int) AS last_day,
       count(DISTINCT "Symbol") AS symbols
FROM ranges LEFT JOIN ticks
  ON "TradeDateParsed" BETWEEN DATE '2024-01-01' + cast(a - 1 AS int) AND DATE '2024-01-01' + cast(b - 1 AS int)
GROUP BY ALL"""

_ROUND_TRIP = _over_summary("SELECT * FROM summary")
_REPLACED = f"WITH {_TICKS}, {_CORRECTED} {_summary_of('corrected')}"

_SQL: dict[str, str] = {
    "ticks_clean": _TICKS_CLEAN,
    "tick_header_drop": _TICKS_CLEAN,
    "delimited_ticks": _TICKS_CLEAN,
    "zip_ticks": _TICKS_CLEAN,
    "incremental_load": _TICKS_CLEAN,
    "ticks_lenient": f"""
  SELECT {_CLEAN_COLUMNS}, cast(ts AS date) AS "TradeDateParsed",
         CASE WHEN event_type <> 'error' THEN cast(value AS decimal(18,4)) END AS "TradePrice",
         CASE WHEN json_extract_string(props, '$.k') <> '0'
              THEN cast(json_extract_string(props, '$.k') AS int) END AS "TradeVolume",
         cast(year(ts) AS int) AS "year", cast(month(ts) AS int) AS "month"
  FROM events WHERE hour(ts) > 0""",
    "load_balance": _LOAD_BALANCE,
    "tick_rejects": _TICK_REJECTS,
    "quarantine": _TICK_REJECTS,
    "hour_bucket": f"""
WITH {_TICKS}, forms AS (
  SELECT unnest([0, 1, 2, 3, 4, 5]) AS form,
         unnest(["TradeTime", regexp_replace("TradeTime", '^0', ''),
                 ltrim(replace("TradeTime", ':', ''), '0'),
                 substr(replace("TradeTime", ':', ''), 1, 3),
                 replace("TradeTime", ':', '') || '99', NULL]) AS clock
  FROM ticks)
SELECT cast(form AS int) AS form, {_hour('clock')} AS hour, count(*) AS n
FROM forms GROUP BY ALL""",
    "cancels_clean": _CANCELS_CLEAN,
    "delimited_cancels": _CANCELS_CLEAN,
    "cancel_rejects": f"""
WITH {_CANCELS}
SELECT * REPLACE ("Price" || '-' AS "Price"), 'Price' AS reasons
FROM cancels WHERE "Amend_Code" = 'P'""",
    "tick_summary": _ROUND_TRIP,
    "csv_round_trip": _ROUND_TRIP,
    "compaction": _ROUND_TRIP,
    "clustered_compaction": _ROUND_TRIP,
    "total_volume_range": _RANGE_TOTALS,
    "summary_of_picked_days": _over_summary("""SELECT * FROM summary WHERE "TradeDateParsed" IN (
    SELECT "TradeDateParsed" FROM summary GROUP BY 1
    HAVING sum("GroupVolume") FILTER ("MessageCode" = 'purchase') > sum("GroupVolume") FILTER ("MessageCode" = 'click'))"""),
    "distinct_symbols_range": _RANGE_SYMBOLS,
    "stream_archives": _ROUND_TRIP,
    "stray_date_load": _ROUND_TRIP,
    "damaged_part_load": _ROUND_TRIP,
    "split_day_stream": _ROUND_TRIP,
    "stream_hourly_corrected": _ROUND_TRIP,
    "emptied_day_load": _over_summary(
        """SELECT * FROM summary WHERE "TradeDateParsed" < DATE '2024-01-25'"""
    ),
    "quarantine_reload": _TICK_REJECTS,
    "incremental_rejects": _TICK_REJECTS,
    "daily_load_csv": _over_summary('SELECT * FROM summary WHERE isodow("TradeDateParsed") < 6'),
    "vwap_sql": _over_summary(_vwap()),
    "symbols_chosen": _over_summary(
        'SELECT "Hour", cast(sum("GroupVolume") AS bigint) AS "Total Volume" FROM summary'
        """ WHERE "Symbol" IN ('U1', 'U2', 'U3') GROUP BY 1"""
    ),
    "daily_load": _over_summary('SELECT * FROM summary WHERE isodow("TradeDateParsed") < 6'),
    "tick_summary_scale": _over_summary("SELECT * FROM summary", _SCALE_TICKS),
    "reaggregation": f"""
WITH {_TICKS} SELECT "TradeDateParsed", "Symbol", {_MEASURES} FROM ticks GROUP BY 1, 2""",
    "summary_profile": _over_summary(
        'SELECT count(*) AS total_rows, min("TradeDateParsed") AS start_date,'
        ' max("TradeDateParsed") AS end_date, count(DISTINCT "Symbol") AS unique_symbols'
        " FROM summary"
    ),
    "symbol_volume": _over_summary(
        'SELECT "Symbol", cast(sum("GroupVolume") AS bigint) AS total_volume,'
        ' count(*) AS row_count FROM summary GROUP BY 1'
    ),
    "summary_sample": _over_summary(
        'SELECT * FROM summary ORDER BY "TradeDateParsed", "Symbol", "MessageCode", "Hour" LIMIT 10'
    ),
    "symbol_values": _over_summary('SELECT DISTINCT "Symbol" FROM summary'),
    "message_code_values": _over_summary('SELECT DISTINCT "MessageCode" FROM summary'),
    "total_volume": _over_summary(
        'SELECT cast(sum("GroupVolume") AS bigint) AS "Total Volume" FROM summary'
    ),
    "total_ticks": _over_summary(
        'SELECT cast(sum("GroupTradeCount") AS bigint) AS "Total Ticks" FROM summary'
    ),
    "total_volume_chosen": _over_summary(
        'SELECT cast(sum("GroupVolume") AS bigint) AS "Total Volume" FROM summary'
        f" WHERE {_CHOSEN}"
    ),
    "vwap_series": _over_summary(_vwap()),
    "vwap_series_scale": _over_summary(_vwap(), _SCALE_TICKS),
    "vwap_series_chosen": _over_summary(_vwap(_CHOSEN)),
    "hourly_liquidity": _over_summary(
        'SELECT "Hour", cast(sum("GroupVolume") AS bigint) AS "Total Volume"'
        " FROM summary GROUP BY 1"
    ),
    "market_share": _over_summary(
        """SELECT TIMESTAMP '2024-01-31 00:00:00' AS "time", "Symbol" AS metric,
       cast(sum("GroupVolume") AS bigint) AS value,
       round(cast(sum("GroupVolume") AS double)
             / (SELECT cast(sum("GroupVolume") AS double) FROM summary), 6) AS share
FROM summary GROUP BY "Symbol\""""
    ),
    "trade_detail_500": _over_summary(
        f"""SELECT "TradeDateParsed" AS "Date", "Hour", "Symbol", "MessageCode" AS "Type",
       "GroupVolume" AS "Volume", "GroupTradeCount" AS "Ticks",
       {_ratio('"GroupPriceVolume"', 'cast("GroupVolume" AS hugeint)')} AS "Avg Price"
FROM summary
ORDER BY "TradeDateParsed" DESC, "Hour" DESC, "Symbol", "MessageCode" LIMIT 500"""
    ),
    "mean_price": _over_summary(
        f"""SELECT "Symbol",
       {_ratio('sum("GroupPriceSum")', 'cast(sum("GroupTradeCount") AS hugeint)')} AS mean_price
FROM summary GROUP BY 1"""
    ),
    "partition_replace": _REPLACED,
    "serving_replace": _REPLACED,
    "stream_replace": _REPLACED,
    "stream_hourly": _STREAM_HOURLY,
    "batch_dates": 'SELECT DISTINCT cast(l_shipdate AS date) AS "TradeDateParsed" FROM lineitem',
    "retention_candidates": (
        "SELECT DISTINCT 'v1' AS version, cast(ts AS date) AS \"TradeDateParsed\" FROM events"
        " WHERE ts < DATE '2024-01-16'"
    ),
    "business_calendar": f"WITH {_DAYS} SELECT job_date FROM days",
    "business_day_count": f"""
WITH spans AS (
  SELECT o_orderkey, cast(o_orderdate AS date) AS a,
         cast(o_orderdate AS date) + cast(o_custkey % 61 - 30 AS int) AS b
  FROM orders)
SELECT o_orderkey, {_signed('a', 'b', True)} AS both_ends, {_signed('a', 'b', False)} AS one_end
FROM spans""",
    "raw_completeness": f"WITH {_COMPLETE} SELECT * FROM complete",
    "days_ready": f"""
WITH {_DAYS}, {_COMPLETE}
SELECT job_date FROM days WHERE job_date IN (SELECT job_date FROM complete WHERE has_ticks)""",
    "days_to_fetch": f"""
WITH {_DAYS}, {_COMPLETE}
SELECT job_date FROM days
WHERE job_date NOT IN (SELECT job_date FROM complete WHERE complete)""",
    "landing_manifest": f"""
WITH {_DAYS}, {_COMPLETE}, expected AS (
  SELECT job_date, unnest([0, 1, 2, 3]) AS n,
         unnest(['WEBPXTICK_DT_' || strftime(job_date, '%Y%m%d') || '.zip',
                 'TC_' || strftime(job_date, '%Y%m%d') || '.txt',
                 'TickData_structure.dat', 'TC_structure.dat']) AS filename
  FROM days),
judged AS (
  SELECT job_date, filename,
         CASE n WHEN 0 THEN coalesce(has_ticks, false) WHEN 1 THEN coalesce(has_cancels, false)
                ELSE false END AS found
  FROM expected LEFT JOIN complete USING (job_date))
SELECT job_date, filename, CASE WHEN found THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN NOT found THEN 'file not found' END AS error,
       CASE WHEN found THEN 'Already exists' END AS info
FROM judged""",
    "feed_id_resolution": _FEED_IDS,
    "run_log_latest": f"""
WITH {_LATEST}
SELECT job_date, status, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
       strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS ended_at, results
FROM latest""",
    "run_report": f"""
WITH {_LOG}
SELECT job_date, status AS run_status, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
       f.filename, f.status, f.error, cast(NULL AS varchar) AS info,
       CASE WHEN status = 'skipped' THEN results END AS note
FROM (
  SELECT *, unnest(CASE WHEN status IN ('success', 'failed') THEN
           [{{'filename': 'WEBPXTICK_DT_' || k || '.zip', 'status': 'success', 'error': NULL}},
            {{'filename': 'TC_' || k || '.txt',
              'status': CASE WHEN missed THEN 'timed out' ELSE 'success' END,
              'error': CASE WHEN missed THEN 'HTTP 504' END}}]
         ELSE [NULL] END) AS f
  FROM run_log)""",
    "run_outcome": f"""
WITH {_LOG} SELECT status, count(*) AS run_count,
       CASE WHEN results LIKE '[%"timed out"%' THEN 'failed' WHEN results LIKE '[%' THEN 'success'
            ELSE status END AS outcome
FROM run_log GROUP BY ALL""",
    "outcome_report": f"""
WITH {_LATEST}
SELECT status, count(*) AS day_count, string_agg(job_date, ',' ORDER BY job_date) AS days
FROM latest GROUP BY 1""",
    "backfill_plan": f"""
WITH {_DAYS}, {_COMPLETE}, {_LATEST}
SELECT days.job_date,
       CASE WHEN coalesce(complete.complete, false) THEN 'etl'
            WHEN latest.status = 'skipped' THEN 'skip' ELSE 'land' END AS action,
       latest.status AS run_status
FROM days LEFT JOIN complete ON complete.job_date = days.job_date
LEFT JOIN latest ON cast(latest.job_date AS date) = days.job_date""",
}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
