"""Streams and sinks, from files, without a broker or database."""

import json
import shutil

import pytest
from tests.test_market import bar_rows

from tidemark.sources.events import bar_csv, replay_stream
from tidemark.streaming import processor, sinks

SYMBOLS = ["NVDA"]


def record(price, size, time, n=None):
    t = f"2026-08-19T13:{time}Z"
    i = n or abs(hash((price, size, time))) % 10**9
    trade = {"T": "t", "S": "NVDA", "i": i, "x": "V", "p": price, "s": size, "c": ["@"], "t": t, "z": "C"}
    return json.dumps({"event_id": f"sha256:{i}", "event_type": "market.trade.raw", "schema_version": 1, "source": "alpaca", "feed": "iex", "source_event_id": str(i), "event_timestamp": t, "ingested_at": t, "trace_id": None, "payload": trade})


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(records))
    (folder / f".{name}").rename(folder / name)


def test_late_duplicate_and_restart(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()

    def begin():
        bars, _ = processor.build_streams(replay_stream(spark, str(landed), 1), SYMBOLS)
        return bars.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "bars")).option("checkpointLocation", str(tmp_path / "state")).start()

    run = begin()
    files = [
        [record(100, 3, "30:10", 1), record(105, 2, "30:30", 2), record(102, 5, "30:50", 3), record(102, 5, "30:50", 3)],
        [record(110, 1, "31:30", 4), record(99, 1, "30:20", 5)], [record(111, 1, "33:30", 6)], [record(500, 100, "30:40", 7)],
    ]
    for i, rows in enumerate(files):
        land(landed, f"f{i}.txt", *rows)
        run.processAllAvailable()
    dropped = sum(s.numRowsDroppedByWatermark for p in run.recentProgress for s in p.stateOperators)
    run.stop()
    rows = spark.read.parquet(str(tmp_path / "bars")).collect()
    assert len(rows) == 1 and [int(rows[0][c]) for c in ("open", "high", "low", "close", "volume", "trade_count")] == [100, 105, 99, 102, 11, 4]
    assert str(rows[0]["vwap"]) == "101.727273" and dropped >= 1
    run = begin()
    run.processAllAvailable()
    run.stop()
    assert spark.read.parquet(str(tmp_path / "bars")).count() == 1


def test_batch_input_is_refused(spark):
    with pytest.raises(ValueError, match="requires a streaming DataFrame"):
        processor.prepare_trades(spark.createDataFrame([("a",)], "event_id string"))


def test_both_outputs_run_side_by_side(spark, tmp_path):
    land(tmp_path / "landed", "a.txt", record(100, 3, "30:10", 1), "not-json", record(111, 1, "34:30", 6))
    bars, invalid = processor.build_streams(replay_stream(spark, str(tmp_path / "landed")), SYMBOLS)
    log, seen = sinks.BarLog(spark, str(tmp_path / "log"), "run"), []
    runs = processor.start(bars, invalid, str(tmp_path / "state"), log.write_batch, lambda counts: seen.extend(counts.collect()), "1 second")
    for q in runs:
        q.processAllAvailable()
        q.stop()
    assert log.current().count() == 1 and len(seen) == 15 and {r["spark_batch_id"] for r in seen} == {0}
    assert processor.checkpoint_paths("x/") == {"bars": "x/bars", "invalid-metrics": "x/invalid-metrics"}


def test_one_read_for_both_outputs(spark, tmp_path):
    got = {}
    df = spark.createDataFrame([(record(100, 3, "30:10", 1),), ("not-json",)], "value string")
    processor.route_batch(SYMBOLS, lambda d, n: got.update(valid=d.count()), lambda d, n: got.update(invalid=d.count()))(df, 0)
    assert got == {"valid": 1, "invalid": 1}


def test_keyed_log_replay_correction_and_rollback(spark, tmp_path):
    log = sinks.BarLog(spark, str(tmp_path / "log"), "r")
    two = bar_rows(spark, {"symbol": "NVDA"}, {"symbol": "SPY"})
    assert log.write_batch(two, 10) == 2 and log.write_batch(two, 11) == 2 and log.write_batch(two.limit(0), 13) == 0
    log.write_batch(bar_rows(spark, {"symbol": "NVDA", "close": "101", "high": "103"}, {"symbol": "SPY"}), 12)
    rows = {r["symbol"]: (str(r["close"]), r["spark_batch_id"]) for r in log.current().collect()}
    assert rows == {"NVDA": ("101.000000", 12), "SPY": ("100.500000", 12)}
    log.write_batch(two, 12)  # a retry replaces its own batch
    assert log.log().count() == 6 and log.current().count() == 2
    for bad, why in (({"close": "106"}, "constraint"), ({"is_final": False}, "final bars"), ({"bar_start": None}, "bar_start")):
        with pytest.raises(ValueError, match=why):
            log.write_batch(bar_rows(spark, {"symbol": "OK"}, bad), 20)
    with pytest.raises(ValueError, match="one key"):
        log.write_batch(bar_rows(spark, {}, {}), 21)
    assert log.log().count() == 6
    log.compact(str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_csv_round_trip(spark, tmp_path):
    df = bar_rows(spark, {"symbol": "B"}, {"symbol": "A", "vwap": None})
    sinks.export_csv(df, str(tmp_path / "csv"))
    assert [r["symbol"] for r in bar_csv(spark, str(tmp_path / "csv")).collect()] == ["A", "B"]
    assert bar_csv(spark, str(tmp_path / "csv")).exceptAll(df.drop("condition_policy")).count() == 0
    with pytest.raises(ValueError):
        sinks.export_csv(df.limit(0), str(tmp_path / "none"))
    shutil.rmtree(tmp_path / "csv")


def test_options_and_statement():
    assert sinks.publish_options("h:1", "t")["kafka.acks"] == "all"
    text = sinks.upsert_statement("staging")
    assert "ON CONFLICT (symbol, bar_start, timeframe, source, feed)" in text and "spark_batch_id = EXCLUDED.spark_batch_id" in text and "symbol = EXCLUDED" not in text
    assert processor.parse_args(["--checkpoints", "c"]).trigger == "5 seconds"


def test_batches_reach_a_database_by_staging(spark, tmp_path):
    """An embedded database stands for the server; the statement that it would run is recorded."""
    url, own, said = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, []
    write = sinks.sink_of(url, own, said.append)
    bars = bar_rows(spark, {"symbol": "NVDA"}, {"symbol": "SPY"})
    write(bars.limit(0), 29)
    assert said == []
    with pytest.raises(ValueError, match="constraint"):
        write(bar_rows(spark, {"close": "106"}), 30)
    for number in (30, 31):
        write(bars, number)
    staged = spark.read.jdbc(url, "market_bars_staging", properties=own).collect()
    assert {(r["symbol"], str(r["close"]), r["spark_batch_id"]) for r in staged} == {("NVDA", "100.500000", 31), ("SPY", "100.500000", 31)}
    assert said == [sinks.upsert_statement("market_bars_staging")] * 2


def test_exports_have_a_digest_and_stay_in_their_folder(spark, tmp_path):
    bars = bar_rows(spark, {"symbol": "B"}, {"symbol": "A", "vwap": None})
    told = sinks.export_csv(bars, str(tmp_path / "out" / "x"), str(tmp_path / "out")).first()
    again = sinks.export_csv(bars, str(tmp_path / "out" / "y"), str(tmp_path / "out"), told["sha256"]).first()
    other = sinks.export_csv(bars.limit(1), str(tmp_path / "out" / "z"), None, told["sha256"]).first()
    assert (told["rows"], told["matches"], again["matches"], other["matches"]) == (2, None, True, False) and len(told["sha256"]) == 64
    with pytest.raises(ValueError, match="inside its folder"):
        sinks.export_csv(bars, str(tmp_path / "out" / ".." / "else"), str(tmp_path / "out"))


def test_the_run_stops_after_its_timeout(spark, tmp_path, monkeypatch, capsys):
    import tidemark.session as session

    class Kept:
        """The session of the tests, which the run may not stop."""

        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    land(tmp_path / "landed", "a.txt", record(100, 3, "30:10", 1), "not-json", record(111, 1, "34:30", 6))
    monkeypatch.setattr(session, "market_session", lambda name: Kept())
    monkeypatch.setattr(processor, "log_stream", lambda s, servers, topic, offsets: replay_stream(spark, str(tmp_path / "landed")))
    table = str(tmp_path / "table")
    processor.main(["--checkpoints", str(tmp_path / "state"), "--bar-table", table, "--symbols", "NVDA", "--timeout", "12", "--trigger", "1 second"])
    assert not spark.streams.active and sinks.BarLog(spark, table).current().count() == 1
    assert "MALFORMED" in capsys.readouterr().out
