"""Fixed schemas; all parsed fields are nullable and judged by the validation rules."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


PAYLOAD = _struct(
    ("T", T.StringType()), ("S", T.StringType()), ("i", T.LongType()), ("x", T.StringType()), ("p", PRICE), ("s", T.LongType()),
    ("c", T.ArrayType(T.StringType(), True)), ("t", T.StringType()), ("z", T.StringType()),
)

ENVELOPE = _struct(
    ("event_id", T.StringType()), ("event_type", T.StringType()), ("schema_version", T.LongType()), ("source", T.StringType()), ("feed", T.StringType()),
    ("source_event_id", T.StringType()), ("event_timestamp", T.StringType()), ("ingested_at", T.StringType()), ("trace_id", T.StringType()), ("payload", PAYLOAD),
)

HISTORICAL_TRADE = _struct(
    ("t", T.StringType()), ("x", T.StringType()), ("p", PRICE), ("s", T.LongType()), ("c", T.ArrayType(T.StringType(), True)), ("i", T.LongType()), ("z", T.StringType()),
)

PAGE = _struct(("symbol", T.StringType()), ("page_no", T.IntegerType()), ("trades", T.ArrayType(HISTORICAL_TRADE, True)), ("next_page_token", T.StringType()))

BAR_CSV = _struct(
    ("symbol", T.StringType()), ("bar_start", T.TimestampType()), ("timeframe", T.StringType()), ("open", PRICE), ("high", PRICE), ("low", PRICE), ("close", PRICE),
    ("volume", T.LongType()), ("trade_count", T.LongType()), ("vwap", PRICE), ("source", T.StringType()), ("feed", T.StringType()), ("is_final", T.BooleanType()),
)

BAR = T.StructType([*BAR_CSV.fields, T.StructField("condition_policy", T.StringType(), True)])
BAR_COLUMNS = BAR.fieldNames()
BAR_KEY = ["symbol", "bar_start", "timeframe", "source", "feed"]

#: Columns of a log record that may be missing, with the types of their renamed copies.
LOG_METADATA = {"topic": T.StringType(), "partition": T.IntegerType(), "offset": T.LongType(), "timestamp": T.TimestampType()}

TRADE_EVENT = "market.trade.raw"
SCHEMA_VERSION = 1
CONDITION_POLICY = "all_valid_trades_v1"
