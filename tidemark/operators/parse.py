"""Raw records to flat trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.schemas import ENVELOPE, LOG_METADATA


def is_malformed(raw: Column) -> Column:
    """True for text that isn't JSON at all, for empty text and for null."""
    return F.get_json_object(raw, "$").isNull()


def parse_events(records: DataFrame) -> DataFrame:
    """`value` (text or bytes) and any log metadata -> 26 flat columns. Fields that don't fit their type become null."""
    metadata = [(F.col(name) if name in records.columns else F.lit(None)).cast(kind).alias(f"kafka_{name}") for name, kind in LOG_METADATA.items()]
    raw = records.select(F.col("value").cast("string").alias("raw_value"), *metadata)
    envelope = F.from_json("raw_value", ENVELOPE)
    # A generator of one row: filters on what it makes stay above it, so every record is parsed once. Without it the
    # optimiser would copy the parsing into each condition of a pushed-down filter.
    read = raw.select("*", F.explode(F.array(F.struct(envelope.alias("envelope"), is_malformed(F.col("raw_value")).alias("is_malformed")))).alias("read"))
    e, p = (lambda name: F.col(f"read.envelope.{name}")), (lambda name: F.col(f"read.envelope.payload.{name}"))
    times = F.struct(F.try_to_timestamp(e("event_timestamp")).alias("event"), F.try_to_timestamp(p("t")).alias("provider"))
    read = read.select("*", F.explode(F.array(times)).alias("times"))
    return read.select(
        "raw_value", *[f"kafka_{name}" for name in LOG_METADATA], "read.is_malformed",
        *[e(name).alias(name) for name in ("event_id", "event_type", "schema_version", "source", "feed", "source_event_id")],
        e("event_timestamp").alias("event_timestamp_raw"), F.col("times.event").alias("event_timestamp"),
        e("ingested_at").alias("ingested_at_raw"), e("trace_id").alias("trace_id"),
        p("T").alias("message_type"), p("S").alias("symbol"), p("i").alias("provider_trade_id"), p("x").alias("exchange"), p("p").alias("price"), p("s").alias("size"), p("c").alias("conditions"),
        p("t").alias("provider_timestamp_raw"), F.col("times.provider").alias("provider_timestamp"), p("z").alias("tape"),
    )


def dedup_batch(trades: DataFrame) -> DataFrame:
    """One row for each event_id: in a bounded table duplicates are dropped as a step of its own."""
    return trades.dropDuplicates(["event_id"])
