"""Feeds against each other and against the clock, on streams: reconciliation, silence and order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.features import judged_feeds
from tidemark.operators.validate import dead_letters

PAIR = ["symbol", "timeframe", "bar_start"]
CODES = "symbol string, code string, event_id string, event_time timestamp, last_event timestamp"


def reconcile_streams(one: DataFrame, two: DataFrame, tolerance_bps: float, delay: str = "20 minutes") -> DataFrame:
    """Final bars of two feeds side by side as they come: the columns of features.reconcile().

    A pair comes out once both bars are there; a bar that stays alone comes out as MISSING once the watermark of both
    feeds has passed it by `delay`, and leaves the state. Bars behind the watermark are dropped, so no pair is judged
    twice. On bars that the watermark has passed the result is that of the batch.
    """
    sides = []
    for df, name in ((one, "iex"), (two, "sip")):
        if not df.isStreaming:
            raise ValueError("reconcile_streams requires streaming DataFrames")
        told = df.withWatermark("bar_start", delay)
        sides.append(told.select(*[F.col(c).alias(f"{name}_{c}") for c in PAIR], F.col("close").cast("double").alias(f"{name}_close"), F.col("volume").alias(f"{name}_volume")))
    a, b = sides
    same = F.lit(True)
    for c in PAIR:
        same = same & (a[f"iex_{c}"] == b[f"sip_{c}"])
    both = a.join(b, same, "fullOuter")
    return judged_feeds(both.select(*[F.coalesce(f"iex_{c}", f"sip_{c}").alias(c) for c in PAIR], "iex_close", "iex_volume", "sip_close", "sip_volume"), tolerance_bps)


class Watch(StatefulProcessor):
    """What a symbol's latest event is, and a timer that goes off when none follows for `limit` milliseconds."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "at timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values(["arrival", "event_id"], kind="stable")
        before = pd.Timestamp(self.latest.get()[0]) if self.latest.exists() else pd.Timestamp.min
        ahead = got["event_time"].cummax().shift(1).fillna(before).clip(lower=before)
        late = got[got["event_time"] < ahead]
        last = max(before, got["event_time"].max())
        self.latest.update((last.to_pydatetime(),))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last.value // 1_000_000 + self.limit)
        yield pd.DataFrame({"symbol": key[0], "code": "OUT_OF_ORDER_EVENT", "event_id": late["event_id"], "event_time": late["event_time"], "last_event": ahead[late.index]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"symbol": [key[0]], "code": ["SOURCE_STALE"], "event_id": [None], "event_time": pd.to_datetime([None]), "last_event": pd.to_datetime([self.latest.get()[0]])})

    def close(self) -> None:
        pass


def watch(trades: DataFrame, event: str, arrival: str, limit_seconds: float, delay: str) -> DataFrame:
    """symbol, code, event_id, event_time, last_event of a stream of trades: OUT_OF_ORDER_EVENT for an event behind one
    that arrived before, SOURCE_STALE once for each silence of a symbol.

    A symbol is silent when the watermark (`delay` behind the latest event of all symbols) has passed its latest event
    by `limit_seconds`; its next event ends the silence. The latest event of each symbol and its timer are the state, so
    a restart raises nothing again. Events behind the watermark are dropped. The rows of a symbol in one micro-batch are
    ordered in memory: the source's limit for each trigger bounds them. Needs the RocksDB state store.
    """
    if not trades.isStreaming:
        raise ValueError("watch requires a streaming DataFrame")
    told = trades.select("symbol", "event_id", F.col(event).alias("event_time"), F.col(arrival).alias("arrival")).withWatermark("event_time", delay)
    return told.groupBy("symbol").transformWithStateInPandas(statefulProcessor=Watch(int(limit_seconds * 1000)), outputStructType=CODES, outputMode="Append", timeMode="EventTime")


def start_dead_letters(invalid: DataFrame, checkpoints: str, sink, every: str = "5 seconds"):
    """Start the query that hands the keyed dead letters of a stream's invalid rows to `sink(records, batch number)`."""
    out = dead_letters(invalid).writeStream.outputMode("append").option("checkpointLocation", f"{checkpoints.rstrip('/')}/dead-letters")
    return out.trigger(processingTime=every).queryName("dead-letters").foreachBatch(sink).start()
