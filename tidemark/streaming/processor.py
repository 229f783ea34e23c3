"""The streaming run: parse, validate, watermark, deduplicate, aggregate; bars and reason counts as two outputs."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import aggregate_bars
from tidemark.operators.parse import parse_events
from tidemark.operators.validate import reason_counts, split_valid_invalid, validate_trades
from tidemark.sources.events import log_stream

WATERMARK = "2 minutes"


def prepare_trades(valid: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Valid trades of a stream with a watermark on event time, each event_id once within it."""
    if not valid.isStreaming:
        raise ValueError("prepare_trades requires a streaming DataFrame")
    return valid.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])


def build_streams(records: DataFrame, symbols: Iterable[str], watermark: str = WATERMARK, duration: str = "1 minute", timeframe: str = "1m") -> tuple[DataFrame, DataFrame]:
    """(final bars, invalid rows) of a stream of records."""
    valid, invalid = split_valid_invalid(validate_trades(parse_events(records), symbols))
    return aggregate_bars(prepare_trades(valid, watermark), duration, timeframe), invalid


def checkpoint_paths(root: str) -> dict[str, str]:
    """Every query has its own checkpoint."""
    return {name: f"{root.rstrip('/')}/{name}" for name in ("bars", "invalid-metrics")}


def metric_batch(sink: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands the batch's reason counts, with the batch's number, to the sink."""
    return lambda batch, number: sink(reason_counts(batch).withColumn("spark_batch_id", F.lit(number).cast("long")))


def route_batch(symbols: list[str], on_valid: Callable[[DataFrame, int], None], on_invalid: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One read for both outputs: the batch is judged once and kept while both sides take their rows."""

    def route(batch: DataFrame, number: int) -> None:
        judged = validate_trades(parse_events(batch), symbols).persist()
        try:
            valid, invalid = split_valid_invalid(judged)
            on_valid(valid, number)
            on_invalid(invalid, number)
        finally:
            judged.unpersist()

    return route


def start(bars: DataFrame, invalid: DataFrame, checkpoints: str, bar_sink: Callable[[DataFrame, int], None] | None, metric_sink: Callable[[DataFrame], None], every: str = "5 seconds") -> list:
    """Start both queries; without a bar sink bars go to the console."""
    paths = checkpoint_paths(checkpoints)
    writer = bars.writeStream.outputMode("append").option("checkpointLocation", paths["bars"]).trigger(processingTime=every).queryName("bars")
    writer = writer.foreachBatch(bar_sink) if bar_sink else writer.format("console").option("truncate", False)
    metrics = invalid.writeStream.outputMode("append").option("checkpointLocation", paths["invalid-metrics"]).trigger(processingTime=every).queryName("invalid-metrics")
    return [writer.start(), metrics.foreachBatch(metric_batch(metric_sink)).start()]


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--servers", default="localhost:9092")
    p.add_argument("--topic", default="raw.market.v1")
    p.add_argument("--symbols", default="")
    p.add_argument("--starting-offsets", choices=("latest", "earliest"), default="latest")
    p.add_argument("--watermark", default=WATERMARK)
    p.add_argument("--trigger", default="5 seconds")
    p.add_argument("--timeout", type=int, help="seconds after which all queries stop")
    p.add_argument("--checkpoints", required=True)
    p.add_argument("--dead-letters", help="folder for keyed records of invalid rows")
    p.add_argument("--bar-table", help="folder of the keyed bar log; without it bars go to the console")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    from tidemark.session import market_session
    from tidemark.streaming.feeds import start_dead_letters
    from tidemark.streaming.sinks import BarLog

    args = parse_args(argv)
    spark: SparkSession = market_session("market-bars")
    bars, invalid = build_streams(log_stream(spark, args.servers, args.topic, args.starting_offsets), [s for s in args.symbols.split(",") if s], args.watermark)
    sink = BarLog(spark, args.bar_table).write_batch if args.bar_table else None
    spark.streams.resetTerminated()  # queries that ended before in this session don't count
    queries = start(bars, invalid, args.checkpoints, sink, lambda counts: counts.show(truncate=False), args.trigger)
    if args.dead_letters:
        # a folder a batch, so that a retry leaves one copy
        queries.append(start_dead_letters(invalid, args.checkpoints, lambda found, n: found.write.mode("overwrite").parquet(f"{args.dead_letters}/batch={n}"), args.trigger))
    try:
        spark.streams.awaitAnyTermination(*([args.timeout] if args.timeout else []))
    finally:
        for q in queries:
            q.stop()
        spark.stop()


if __name__ == "__main__":
    main()
