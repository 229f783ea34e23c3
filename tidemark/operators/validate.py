"""The validation rules. Every rule that a row breaks is named, in the order below."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.schemas import SCHEMA_VERSION, TRADE_EVENT

#: A timestamp text must end in a zone.
ZONED = r"(?i)(Z|[+-]\d{2}:\d{2})$"
#: A full date in front: without it a time of day parses as today's.
DATED = r"^\d{4}-\d{2}-\d{2}[T ]"


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def _isnt(name: str, value) -> Column:
    return ~F.col(name).eqNullSafe(F.lit(value))


def rules(allowed_symbols: Iterable[str], require_date: bool = False) -> list[tuple[str, Column]]:
    symbols = sorted({s.strip().upper() for s in allowed_symbols})
    listed = F.col("symbol").isin(symbols) if symbols else F.lit(False)
    pattern = [ZONED, DATED] if require_date else [ZONED]
    odd_text = [~F.coalesce(F.col(c).rlike(x), F.lit(False)) for c in ("event_timestamp_raw", "provider_timestamp_raw") for x in pattern]
    bad_time = F.col("event_timestamp").isNull() | F.col("provider_timestamp").isNull()
    for odd in odd_text:
        bad_time = bad_time | odd
    return [
        ("MALFORMED_JSON", F.col("is_malformed")),
        ("INVALID_EVENT_TYPE", _isnt("event_type", TRADE_EVENT) | _isnt("message_type", "t")),
        ("UNSUPPORTED_SCHEMA_VERSION", _isnt("schema_version", SCHEMA_VERSION)),
        ("MISSING_EVENT_ID", _blank("event_id")),
        ("MISSING_SOURCE_EVENT_ID", _blank("source_event_id")),
        ("MISSING_SOURCE", _blank("source")),
        ("MISSING_FEED", _blank("feed")),
        ("SOURCE_EVENT_ID_MISMATCH", F.trim("source_event_id") != F.col("provider_trade_id").cast("string")),
        ("SYMBOL_NOT_ALLOWED", ~F.coalesce(listed, F.lit(False))),
        ("INVALID_PROVIDER_TRADE_ID", F.col("provider_trade_id").isNull()),
        ("INVALID_EXCHANGE", _blank("exchange")),
        ("INVALID_CONDITIONS", F.col("conditions").isNull()),
        ("INVALID_TAPE", _blank("tape")),
        ("INVALID_PRICE", F.col("price").isNull() | (F.col("price") <= 0)),
        ("INVALID_SIZE", F.col("size").isNull() | (F.col("size") < 0)),
        ("INVALID_TIMESTAMP", bad_time),
        ("TIMESTAMP_MISMATCH", F.col("event_timestamp") != F.col("provider_timestamp")),
    ]


def validate_trades(trades: DataFrame, allowed_symbols: Iterable[str], require_date: bool = False) -> DataFrame:
    """trades with `reason_codes`, empty for valid rows and never null."""
    codes = F.array(*[F.when(broken, F.lit(code)) for code, broken in rules(allowed_symbols, require_date)])
    # A generator of one row, as in parsing: filters on the codes then name one attribute. Were the codes an alias, the
    # optimiser would derive constraints for every combination of the columns that the rules name, and fill the heap.
    return trades.select("*", F.explode(F.array(F.filter(codes, lambda c: c.isNotNull()))).alias("reason_codes"))


def split_valid_invalid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    broken = F.size("reason_codes")
    return validated.filter(broken == 0), validated.filter(broken > 0)


def reason_counts(invalid: DataFrame) -> DataFrame:
    """How many rows each code was given to."""
    return invalid.select(F.explode("reason_codes").alias("reason_code")).groupBy("reason_code").agg(F.count(F.lit(1)).alias("count"))


def dead_letters(invalid: DataFrame) -> DataFrame:
    """Keyed records for a dead-letter sink: what was wrong, with which record, from where."""
    return invalid.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct("reason_codes", "source", "schema_version", "event_id", "raw_value"), {"ignoreNullFields": "false"}).alias("value"),
    )
