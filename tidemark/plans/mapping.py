"""The event table as market trades: how the registered queries feed the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schemas import PRICE, TRADE_EVENT
from tidemark.operators.bars import aggregate_bars
from tidemark.operators.envelope import event_id
from tidemark.operators.parse import dedup_batch, parse_events
from tidemark.operators.validate import split_valid_invalid, validate_trades
from tidemark.session import prepare

SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, symbol, price, size, time, time_text, event_id: an event as a trade."""
    events = prepare(spark).read.parquet(f"{sf_dir}/events.parquet")
    time = F.col("ts").cast("timestamp")
    named = events.select(
        F.col("event_id").alias("id"), F.upper("event_type").alias("symbol"), F.col("value").cast(PRICE).alias("price"), F.get_json_object("props", "$.k").cast("long").alias("size"),
        time.alias("time"), F.date_format(time, ISO).alias("time_text"), "user_id",
    )
    return named.withColumn("event_id", event_id(F.lit("driver"), F.lit("iex"), F.col("symbol"), F.col("id"), F.col("time_text")))


def _payload(**other) -> list:
    own = {
        "T": F.lit("t"), "S": F.col("symbol"), "i": F.col("id"), "x": F.lit("V"), "p": F.col("price"), "s": F.col("size"), "c": F.array(F.lit("@")), "t": F.col("time_text"), "z": F.lit("C"),
    } | other
    return [c.alias(name) for name, c in own.items()]


def _envelope(payload: list, **other):
    own = {
        "event_id": F.col("event_id"), "event_type": F.lit(TRADE_EVENT), "schema_version": F.lit(1).cast("long"), "source": F.lit("driver"), "feed": F.lit("iex"), "source_event_id": F.col("id").cast("string"),
        "event_timestamp": F.col("time_text"), "ingested_at": F.col("time_text"), "trace_id": F.lit(None).cast("string"), "payload": F.struct(*payload),
    } | other
    return F.to_json(F.struct(*[c.alias(name) for name, c in own.items()]), {"ignoreNullFields": "false"})


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value and offset of clean event records."""
    return records_by_user(spark, sf_dir).drop("partition")


def records_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with `partition`, 0 for users with even ids."""
    return trades(spark, sf_dir).select(_envelope(_payload()).alias("value"), F.col("id").alias("offset"), (F.col("user_id") % 2).cast("int").alias("partition"))


def faulty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one fault each, by id modulo 20; 0, 18 and 19 stay clean."""
    fault, null = F.col("id") % 20, F.lit(None)

    def at(n: int, bad, good):
        return F.when(fault == n, bad).otherwise(good)

    payload = _payload(
        S=at(9, F.lower("symbol"), F.col("symbol")), i=at(10, null, F.col("id")), x=at(11, F.lit(""), F.lit("V")), c=at(12, null, F.array(F.lit("@"))), z=at(13, F.lit(" "), F.lit("C")),
        p=at(14, F.lit(-1).cast(PRICE), F.col("price")), s=at(15, F.lit(-1).cast("long"), F.col("size")),
        t=at(16, F.lit("yesterday"), at(17, F.date_format(F.col("time") + F.expr("interval 1 second"), ISO), F.col("time_text"))),
    )
    text = _envelope(
        payload, event_type=at(2, F.lit("market.quote.raw"), F.lit(TRADE_EVENT)), schema_version=at(3, F.lit(2), F.lit(1)).cast("long"), event_id=at(4, F.lit(" "), F.col("event_id")),
        source_event_id=at(5, F.lit(""), at(8, F.lit("x"), F.col("id").cast("string"))), source=at(6, F.lit(""), F.lit("driver")), feed=at(7, null, F.lit("iex")),
    )
    return trades(spark, sf_dir).select(at(1, F.lit("not-json"), text).alias("value"), F.col("id").alias("offset"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider messages: trades, with every tenth a subscription and every tenth an error; some trades lack a key."""
    kind = F.col("id") % 10
    trade = F.to_json(F.struct(*_payload()))
    partial = F.to_json(F.struct(*_payload()[:-1]))
    text = F.when(kind == 0, F.lit('{"T":"subscription","trades":["*"]}')).when(kind == 1, F.format_string('{"T":"error","code":%d,"msg":"limit"}', (400 + F.col("id") % 3).cast("int"))).when(F.col("id") % 7 == 0, partial).otherwise(trade)
    return trades(spark, sf_dir).select("id", text.alias("value"))


def pages(spark: SparkSession, sf_dir: str, ids_per_page: int = 500) -> DataFrame:
    """Landed pages of historical trades, cut by id; the last page of ERROR is missing."""
    one = F.struct(F.col("time_text").alias("t"), F.lit("V").alias("x"), F.col("price").alias("p"), F.col("size").alias("s"), F.array(F.lit("@")).alias("c"), F.col("id").alias("i"), F.lit("C").alias("z"))
    cut = trades(spark, sf_dir).withColumn("page_no", F.expr(f"cast(id div {ids_per_page} + 1 as int)")).withColumn("trade", one)
    grouped = cut.groupBy("symbol", "page_no").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("id").alias("k"), "trade"))), lambda x: x["trade"]).alias("trades"))
    last = cut.groupBy("symbol").agg(F.max("page_no").alias("last"))
    told = grouped.join(last, "symbol").withColumn("next_page_token", F.when(F.col("page_no") < F.col("last"), F.concat(F.lit("p"), F.col("page_no") + 1)))
    return told.filter("not (symbol = 'ERROR' and page_no = last)").select("symbol", "page_no", "trades", "next_page_token")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_of(records(spark, sf_dir))


def valid_of(records: DataFrame) -> DataFrame:
    return split_valid_invalid(validate_trades(parse_events(records), SYMBOLS))[0]


def bars(spark: SparkSession, sf_dir: str, duration: str = "1 minute", timeframe: str = "1m") -> DataFrame:
    return aggregate_bars(dedup_batch(valid(spark, sf_dir)), duration, timeframe)
