"""Column names and types of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the exchange's daily files and of the published
# tables. They must stay as they are for existing readers of those tables.
RAW_TICK_COLUMNS = [
    "Comm", "Contract_Type", "Mth_Code", "Year", "Strike",
    "Log_Time", "Msg_Code", "Trade_Date", "Price", "Volume",
]
RAW_CANCEL_COLUMNS = [
    "Commodity", "Contract_Type", "Delivery_Month", "Delivery_Year", "Strike_Price",
    "Business_Date", "Match_Time", "Price_Indicator", "Message_Code", "Amend_Code",
    "Price", "Volume",
]

DATE_KEY = "TradeDateParsed"

# States a landing run can be in.
RUNNING, SUCCESS, FAILED, SKIPPED = "running", "success", "failed", "skipped"


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()

RAW_TICKS = _fields(*[(name, _S) for name in RAW_TICK_COLUMNS])
ZIPPED_TICKS = _fields(*[(name, _S) for name in [*RAW_TICK_COLUMNS, "path", "member"]])
RAW_CANCELS = _fields(*[(name, _S) for name in RAW_CANCEL_COLUMNS])

TICKS = _fields(
    ("Symbol", _S), ("ContractType", _S), ("MonthCode", _S), ("DeliveryYear", _S),
    ("StrikePrice", _S), ("TradeTime", _S), ("MessageCode", _S), (DATE_KEY, _D),
    ("TradePrice", T.DecimalType(18, 4)), ("TradeVolume", _I), ("year", _I), ("month", _I),
)

CANCELS = _fields(
    ("Symbol", _S), ("ContractType", _S), ("DeliveryMonth", _S), ("DeliveryYear", _S),
    ("StrikePrice", _S), ("TradeDate", _S), ("CancelTime", _S), ("PriceIndicator", _S),
    ("MessageCode", _S), ("AmendCode", _S), (DATE_KEY, _D), ("Price", T.DoubleType()),
    ("Volume", _I), ("year", _I), ("month", _I),
)

SUMMARY = _fields(
    (DATE_KEY, _D), ("Symbol", _S), ("MessageCode", _S), ("Hour", _S),
    ("GroupVolume", _L), ("GroupTradeCount", _L),
    ("GroupPriceVolume", T.DecimalType(38, 4)), ("GroupPriceSum", T.DecimalType(28, 4)),
)
SUMMARY_KEYS = [DATE_KEY, "Symbol", "MessageCode", "Hour"]

RUN_LOG = _fields(
    ("job_date", _S), ("status", _S),
    ("started_at", T.TimestampType()), ("ended_at", T.TimestampType()), ("results", _S),
)
FILE_RESULTS = T.ArrayType(
    _fields(("filename", _S), ("status", _S), ("error", _S), ("info", _S))
)

# Columns of Spark's file listing source.
BINARY_FILE = _fields(
    ("path", _S), ("modificationTime", T.TimestampType()), ("length", _L),
    ("content", T.BinaryType()),
)
LISTING = _fields(("path", _S), ("length", _L), ("modificationTime", T.TimestampType()))
