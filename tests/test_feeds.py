"""Streams of two feeds, silent and late sources, dead letters: from files, equal to the batch, safe to restart."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.test_streaming import land, record

from tidemark.operators import features
from tidemark.sources.events import replay_stream
from tidemark.streaming import feeds, processor

T0 = datetime(2026, 8, 19, 13, 30)
BAR = "symbol string, bar_start timestamp, timeframe string, close decimal(18,6), volume long"
TRADE = "symbol string, event_id string, at timestamp, arrival timestamp"


@pytest.fixture()
def rocks(spark):
    """The state store that transformWithState needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def bar(minute, close, volume=10, symbol="S"):
    return json.dumps({"symbol": symbol, "bar_start": (T0 + timedelta(minutes=minute)).isoformat() + "Z", "timeframe": "1m", "close": close, "volume": volume})


def trade(symbol, event_id, second, arrival):
    at = lambda s: (T0 + timedelta(seconds=s)).isoformat() + "Z"
    return json.dumps({"symbol": symbol, "event_id": event_id, "at": at(second), "arrival": at(arrival)})


def stream(spark, folder, schema):
    folder.mkdir(exist_ok=True)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def run_to_end(spark, df, tmp_path, name):
    run = df.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


def test_feeds_are_reconciled_as_in_batch(spark, tmp_path):
    iex, sip = tmp_path / "iex", tmp_path / "sip"
    land(iex, "0.txt", bar(0, 182.42, 12500), bar(1, 100.0), bar(2, 100.0))
    land(sip, "0.txt", bar(0, 182.39, 48120), bar(2, 101.0), bar(3, 50.0))
    found = feeds.reconcile_streams(stream(spark, iex, BAR), stream(spark, sip, BAR), 5.0)
    early = {(r["bar_start"], r["status"]) for r in run_to_end(spark, found, tmp_path, "out").collect()}
    assert early == {(T0, "MATCHED"), (T0 + timedelta(minutes=2), "DIVERGED")}  # bars alone wait for the watermark
    for n, late in ((1, []), (2, [bar(1, 100.0)])):  # the late bar is behind the watermark by then
        land(iex, f"{n}.txt", bar(59 + n, 1.0))
        land(sip, f"{n}.txt", bar(59 + n, 1.0), *late)
        run_to_end(spark, feeds.reconcile_streams(stream(spark, iex, BAR), stream(spark, sip, BAR), 5.0), tmp_path, "out")
    settled = T0 + timedelta(minutes=40)
    batch = features.reconcile(*[spark.read.schema(BAR).json(str(f / "0.txt")) for f in (iex, sip)], 5.0, F.lit(settled))
    streamed = spark.read.parquet(str(tmp_path / "out")).filter(F.col("bar_start") < F.lit(settled))
    columns = ["bar_start", "status", "close_diff_bps", "volume_ratio"]
    assert sorted(map(str, streamed.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    assert {r["status"] for r in batch.collect()} == {"MATCHED", "DIVERGED", "MISSING_IEX", "MISSING_SIP"}


def test_a_silence_is_raised_once_and_a_restart_raises_nothing(rocks, tmp_path):
    landed = tmp_path / "landed"

    def again():
        out = feeds.watch(stream(rocks, landed, TRADE), "at", "arrival", 60, "10 seconds")
        rows = run_to_end(rocks, out, tmp_path, "codes").collect()
        return sorted(((r["symbol"], r["code"], r["event_id"], int((r["last_event"] - T0).total_seconds())) for r in rows), key=str)

    land(landed, "0.txt", trade("A", "a1", 0, 0), trade("A", "a2", 5, 1), trade("A", "a3", 3, 2), trade("B", "b1", 1, 3))
    assert again() == [("A", "OUT_OF_ORDER_EVENT", "a3", 5)]
    land(landed, "1.txt", trade("B", "b2", 100, 100))  # A has been silent for a minute by the clock of all events
    land(landed, "2.txt", trade("B", "b3", 101, 101))
    once = [("A", "OUT_OF_ORDER_EVENT", "a3", 5), ("A", "SOURCE_STALE", None, 5)]
    assert again() == once
    assert again() == once  # a restart without anything new
    land(landed, "3.txt", trade("B", "b4", 130, 130))
    assert again() == once  # the silence goes on
    land(landed, "4.txt", trade("A", "a4", 131, 131), trade("A", "a5", 125, 132))
    land(landed, "5.txt", trade("B", "b5", 230, 230))
    land(landed, "6.txt", trade("B", "b6", 231, 231))
    assert sorted(again(), key=str) == sorted([*once, ("A", "OUT_OF_ORDER_EVENT", "a5", 131), ("A", "SOURCE_STALE", None, 131)], key=str)


def test_dead_letters_leave_as_keyed_records(spark, tmp_path):
    land(tmp_path / "landed", "a.txt", record(100, 3, "30:10", 1), "not-json", record(-1, 1, "34:30", 6))
    _, invalid = processor.build_streams(replay_stream(spark, str(tmp_path / "landed")), ["NVDA"])
    seen = []
    run = feeds.start_dead_letters(invalid, str(tmp_path / "state"), lambda batch, n: seen.extend((n, r["key"], json.loads(r["value"])["reason_codes"]) for r in batch.collect()), "1 second")
    run.processAllAvailable()
    run.stop()
    assert sorted((n, k or "") for n, k, _ in seen) == [(0, ""), (0, "NVDA")] and any("INVALID_PRICE" in codes for _, _, codes in seen)


def test_batch_input_is_refused(spark):
    bars, trades = spark.createDataFrame([], BAR), spark.createDataFrame([], TRADE)
    with pytest.raises(ValueError, match="streaming"):
        feeds.reconcile_streams(bars, bars, 1.0)
    with pytest.raises(ValueError, match="streaming"):
        feeds.watch(trades, "at", "arrival", 1, "1 second")
