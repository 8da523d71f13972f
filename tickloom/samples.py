"""The TPC-H-like test tables in the shape of the exchange's files and tables.

Used by the registered queries, the tests and the benchmark only.
"""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.schemas import FAILED, RAW_TICK_COLUMNS, RUNNING, SKIPPED, SUCCESS
from tickloom.sinks.tables import CSV_OPTIONS
from tickloom.sources.files import list_files, locate, per_row

# Fixed value: exchange letters of the twelve delivery months.
MONTH_LETTERS = "FGHJKMNQUVXZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ticks from events: a user is a symbol, an event type a message code."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("Symbol"),
        F.col("event_type").alias("MessageCode"),
        F.to_date("ts").alias("TradeDateParsed"),
        F.date_format("ts", "HH:mm:ss").alias("TradeTime"),
        F.col("value").cast("decimal(18,4)").alias("TradePrice"),
        F.get_json_object("props", "$.k").cast("int").alias("TradeVolume"),
    )


def ticks_of_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks from events, dealt over four months by their volume."""
    later = (F.col("TradeVolume") % 4 * 30).cast("int")
    return ticks(spark, sf_dir).withColumn("TradeDateParsed", F.date_add("TradeDateParsed", later))


def ticks_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ticks from line items: a part is a symbol, a return flag a message code."""
    clock = (F.col("l_orderkey") % 24) * 10000 + F.col("l_linenumber") * 100
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("Symbol"),
        F.col("l_returnflag").alias("MessageCode"),
        F.to_date("l_shipdate").alias("TradeDateParsed"),
        clock.cast("string").alias("TradeTime"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("TradePrice"),
        F.col("l_quantity").cast("int").alias("TradeVolume"),
    )


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text ticks from events, with padded symbols."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(" U"), "user_id", F.lit(" ")).alias("Comm"),
        F.lit("F").alias("Contract_Type"),
        F.lit(MONTH_LETTERS).substr(F.month("ts"), F.lit(1)).alias("Mth_Code"),
        F.year("ts").cast("string").alias("Year"),
        F.lit("0").alias("Strike"),
        F.date_format("ts", "HH:mm:ss").alias("Log_Time"),
        F.col("event_type").alias("Msg_Code"),
        F.date_format("ts", "yyyyMMdd").alias("Trade_Date"),
        F.col("value").cast("decimal(18,4)").cast("string").alias("Price"),
        F.get_json_object("props", "$.k").alias("Volume"),
    )


def flawed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ticks with cells that do not parse.

    Dates in the first hour of a day, prices of errors, and volumes of zero.
    """
    first_hour = F.col("Log_Time").startswith("00")
    mark = F.when(F.col("Msg_Code") == "error", "?").otherwise("")
    return raw_ticks(spark, sf_dir).withColumns({
        "Trade_Date": F.when(first_hour, "abc").otherwise(F.col("Trade_Date")),
        "Price": F.concat("Price", mark),
        "Volume": F.regexp_replace("Volume", "^0$", "0.5"),
    })


def raw_cancels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text cancellations from orders: a customer is a commodity."""
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("  ")).alias("Commodity"),
        F.lit("F").alias("Contract_Type"),
        F.lit(MONTH_LETTERS).substr(F.month(day), F.lit(1)).alias("Delivery_Month"),
        F.year(day).cast("string").alias("Delivery_Year"),
        F.lit("0").alias("Strike_Price"),
        F.date_format(day, "yyyyMMdd").alias("Business_Date"),
        ((F.col("o_orderkey") % 24) * 10000).cast("string").alias("Match_Time"),
        F.substring("o_orderpriority", 1, 1).alias("Price_Indicator"),
        F.lit("C").alias("Message_Code"),
        F.col("o_orderstatus").alias("Amend_Code"),
        F.col("o_totalprice").cast("decimal(18,4)").cast("string").alias("Price"),
        (F.col("o_custkey") % 100).cast("string").alias("Volume"),
    )


def write_delimited(raw: DataFrame, path: str, sep: str = ",") -> None:
    raw.write.options(**CSV_OPTIONS, sep=sep).csv(path)


def write_raw_zone(
    raw: DataFrame, root: str, day: str | Column = "Trade_Date", delivery: str = ""
) -> None:
    """Raw ticks as one archive per file day and written file.

    Spark writes the text by day; each text file is then packed by its own task,
    streaming, next to the other days' archives. Each delivery has files of its own.
    """
    by_day = raw.withColumn("day", F.col(day) if isinstance(day, str) else day).hint("rebalance", "day")
    by_day.write.options(**CSV_OPTIONS).partitionBy("day").csv(f"{root}/text{delivery}")
    listing = list_files(raw.sparkSession, f"{root}/text{delivery}", "*.csv")
    folder = F.regexp_replace("path", f"/text{delivery}/day=[^/]+/.*$", "")
    part = F.regexp_extract("path", r"/part-(\d+)", 1)
    plan = listing.select(
        "path",
        F.regexp_extract("path", "/day=([^/]+)/", 1).alias("day"),
        F.concat_ws("/", folder, F.lit("raw")).alias("base"),
        F.concat(part, F.lit(delivery)).alias("part"),
    )

    def pack(row: dict):
        name = f"WEBPXTICK_DT_{row['day']}.zip"
        target = f"{row['base']}/{row['day']}/{row['part']}/{name}"
        system, source_path = locate(row["path"])
        _, target_path = locate(target)
        system.create_dir(target_path.rpartition("/")[0])
        with system.open_input_stream(source_path) as source:
            with system.open_output_stream(target_path) as sink:
                with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                    with archive.open("ticks.csv", "w", force_zip64=True) as member:
                        while data := source.read(1 << 20):
                            member.write(data)
        yield pa.RecordBatch.from_pydict({"path": [target]})

    plan.mapInArrow(per_row(pack), "path string").write.parquet(f"{root}/packed{delivery}")


def write_day_files(days: DataFrame, root: str, content: bytes, delivery: str) -> None:
    """The same archive content for each day (``day``) of a raw zone, as one more file of the day."""

    def put(row: dict):
        target = f"{root}/raw/{row['day']}/{delivery}/WEBPXTICK_DT_{row['day']}.zip"
        system, path = locate(target)
        system.create_dir(path.rpartition("/")[0])
        with system.open_output_stream(path) as sink:
            sink.write(content)
        yield pa.RecordBatch.from_pydict({"path": [target]})

    days.select("day").distinct().mapInArrow(per_row(put), "path string").write.parquet(f"{root}/put{delivery}")


def header_only_archive() -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("ticks.csv", ",".join(RAW_TICK_COLUMNS))
    return buffer.getvalue()


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing runs from orders: one attempt per order, on the order's day."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    started = F.to_timestamp(day) + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    tick_name = F.concat(F.lit("WEBPXTICK_DT_"), F.date_format(day, "yyyyMMdd"), F.lit(".zip"))
    cancel_name = F.concat(F.lit("TC_"), F.date_format(day, "yyyyMMdd"), F.lit(".txt"))
    no_text = F.lit(None).cast("string")

    def file(name: Column, status: Column, error: Column) -> Column:
        return F.struct(name.alias("filename"), status.alias("status"), error.alias("error"))

    urgent = F.col("o_orderpriority") == "1-URGENT"
    # The files decide, not the state: some runs that say success miss a file.
    missed = urgent | (F.col("o_orderkey") % 7 == 0)
    files = F.to_json(F.array(
        file(tick_name, F.lit(SUCCESS), no_text),
        file(cancel_name, F.when(missed, "timed out").otherwise(SUCCESS),
             F.when(missed, "HTTP 504")),
    ))
    low = F.col("o_orderpriority") == "5-LOW"
    status = (
        F.when(F.col("o_orderstatus") == "P", RUNNING).when(low, SKIPPED)
        .when(urgent, FAILED).otherwise(SUCCESS)
    )
    return table(spark, sf_dir, "orders").select(
        F.date_format(day, "yyyy-MM-dd").alias("job_date"),
        status.alias("status"),
        started.alias("started_at"),
        F.when(status != RUNNING, started + F.expr("interval 5 minutes")).alias("ended_at"),
        F.when(status == SKIPPED, "Holiday or Weekend")
        .when(status != RUNNING, files).alias("results"),
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed lookups from orders: made for the order's day, finding it, nothing or an error."""
    day = F.to_date("o_orderdate")
    ident = F.datediff(day, F.lit("1995-01-01").cast("date")) + 1000
    found = F.col("o_orderstatus") == "F"
    error = F.when(F.col("o_orderstatus") == "P", "connection reset")
    # Lookups of days in the first half of a month all fail to find the day.
    header = F.when(
        found & (F.dayofmonth(day) > 15),
        F.concat(F.lit("attachment; filename=WEBPXTICK_DT-"), F.date_format(day, "yyyyMMdd"), F.lit(".zip")),
    )
    return table(spark, sf_dir, "orders").select(
        day.alias("job_date"),
        ident.alias("feed_id"),
        F.when(header.isNotNull(), 200).when(error.isNull(), 404).alias("status_code"),
        header.alias("content_disposition"),
        # Errors only in even months: other days are looked up without a fault.
        F.when(F.month(day) % 2 == 0, error).alias("error"),
    )


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw-zone listing: tick archives on shipping days, cancellations on order days."""
    def files(source: DataFrame, day: str, prefix: str, extension: str) -> DataFrame:
        d = F.to_date(day)
        # The day is taken from an aggregate: filters on the path then stay above it.
        days = source.groupBy(d).agg(F.max(d).alias("d"), F.count("*").alias("length"))
        key = F.date_format("d", "yyyyMMdd")
        name = F.concat(F.lit("file:/raw/"), key, F.lit(f"/{prefix}_"), key, F.lit(extension))
        return days.select(name.alias("path"), "length")

    archives = files(table(spark, sf_dir, "lineitem"), "l_shipdate", "WEBPXTICK_DT", ".zip")
    # Cancellation files are missing at the end of each month.
    orders = table(spark, sf_dir, "orders").where("day(o_orderdate) < 28")
    cancels = files(orders, "o_orderdate", "TC", ".txt")
    return archives.unionByName(cancels)


def order_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last order date as one row."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).agg(
        F.min("d").alias("first"), F.max("d").alias("last")
    )
