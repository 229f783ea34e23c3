"""Provider trades to event envelopes, and the landed pages of historical trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.schemas import SCHEMA_VERSION, TRADE_EVENT

#: Keys that a complete trade message has.
TRADE_KEYS = ["T", "S", "i", "x", "p", "s", "c", "t", "z"]
#: Keys without which no envelope can be built, in the order in which a missing one is named.
REQUIRED_KEYS = ["T", "S", "i", "t"]


def event_id(source: Column, feed: Column, symbol: Column, trade_id: Column, time: Column) -> Column:
    """`sha256:` and the digest of the compact JSON array of what identifies a trade."""
    identity = F.to_json(F.array(source, feed, F.lit(TRADE_EVENT), symbol, trade_id.cast("string"), time))
    return F.concat(F.lit("sha256:"), F.sha2(identity.cast("binary"), 256))


def utc_iso(time: Column) -> Column:
    """A timestamp as ISO text with Z, without a fraction where it is zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(time), F.lit(1_000_000))
    return F.concat(whole, F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))), F.lit("Z"))


def trade_messages(messages: DataFrame) -> DataFrame:
    """Of provider messages (JSON text in `value`) those that are trades."""
    return messages.filter(F.get_json_object("value", "$.T") == "t")


def is_complete_trade(value: Column) -> Column:
    keys = F.json_object_keys(value)
    return F.coalesce((F.size(F.array_except(F.array(*map(F.lit, TRADE_KEYS)), keys)) == 0) & (F.get_json_object(value, "$.T") == "t"), F.lit(False))


def control_errors(messages: DataFrame) -> DataFrame:
    """code, message and count of the provider's error messages; a run must stop on any."""
    errors = messages.filter(F.get_json_object("value", "$.T") == "error")
    return errors.groupBy(F.get_json_object("value", "$.code").cast("long").alias("code"), F.get_json_object("value", "$.msg").alias("message")).agg(F.count(F.lit(1)).alias("count"))


def build_envelopes(messages: DataFrame, source: str, feed: str, ingested_at: Column, trace_id: Column | None = None) -> DataFrame:
    """Trade messages (`value`) -> key (symbol), event_id, value (the envelope as JSON). The payload's text stays as
    it is. A message without a required key fails the job and names the key."""
    get = {k: F.get_json_object("value", f"$.{k}") for k in REQUIRED_KEYS}
    missing = F.coalesce(*[F.when(get[k].isNull(), F.lit(k)) for k in REQUIRED_KEYS])
    checked = messages.withColumn("value", F.when(missing.isNull(), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("trade message without "), missing)).cast("string")))
    named = checked.select("value", get["S"].alias("S"), get["i"].alias("i"), get["t"].alias("t")).withColumn("event_id", event_id(F.lit(source), F.lit(feed), F.col("S"), F.col("i"), F.col("t")))
    head = F.struct(
        "event_id", F.lit(TRADE_EVENT).alias("event_type"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(source).alias("source"), F.lit(feed).alias("feed"), F.col("i").alias("source_event_id"),
        F.col("t").alias("event_timestamp"), utc_iso(ingested_at).alias("ingested_at"), (F.lit(None).cast("string") if trace_id is None else trace_id).alias("trace_id"),
    )
    text = F.to_json(head, {"ignoreNullFields": "false"})
    body = F.concat(F.substring(text, 1, F.length(text) - 1), F.lit(',"payload":'), F.trim("value"), F.lit("}"))
    return named.select(F.col("S").alias("key"), "event_id", body.alias("value"))


def pages_to_trades(pages: DataFrame) -> DataFrame:
    """Landed pages -> symbol, page_no, position and the provider fields of each trade, with T and S filled in."""
    return pages.select("symbol", "page_no", F.posexplode("trades").alias("position", "trade")).select("symbol", "page_no", "position", F.lit("t").alias("T"), F.col("symbol").alias("S"), "trade.*")


def page_completeness(pages: DataFrame) -> DataFrame:
    """For each symbol: pages, trades, last page, and whether the set is complete: pages 1 to n, each but the last with
    a token for the next, the last without."""
    last = F.max_by("next_page_token", "page_no")
    tokens = F.count("next_page_token")
    return pages.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.coalesce(F.array_size("trades"), F.lit(0))).cast("long").alias("trades"), F.max("page_no").alias("last_page"),
        ((F.max(F.struct("page_no", "next_page_token"))["next_page_token"].isNull()) & (F.max("page_no") == F.count_distinct("page_no")) & (tokens == F.count(F.lit(1)) - 1)).alias("is_complete"),
    )


def complete_pages_only(pages: DataFrame) -> DataFrame:
    """pages, or a failing job if any symbol's set isn't complete: a truncated history must not pass as a whole one."""
    state = page_completeness(pages).select(F.col("symbol").alias("__symbol"), "is_complete")
    joined = pages.join(state, F.col("symbol") == F.col("__symbol"))
    return joined.filter(F.col("is_complete") | F.raise_error(F.concat(F.lit("incomplete pages for "), F.col("symbol"))).cast("boolean")).select(pages.columns)


def first_trades(trades: DataFrame, n: int) -> DataFrame:
    """The first n trades by time, ties by event_id: the cap of a collection run."""
    return trades.orderBy("event_timestamp", "event_id").limit(n)


def publish_records(trades: DataFrame) -> DataFrame:
    """key and value of the records to publish, both bytes."""
    return trades.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """For each key the row with the largest `order` columns; of several any one. Rows are compared before they are
    shuffled, so that a hot key comes down to a row for each task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
