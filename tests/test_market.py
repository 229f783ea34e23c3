"""Parsing, validation, bars and checks, on small hand-made records."""

import copy
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.schemas import BAR
from tidemark.operators import bars, envelope, parse, quality, validate
from tidemark.sources import events as sources

TRADE = {"T": "t", "S": "NVDA", "i": 23, "x": "V", "p": 221.69, "s": 5, "c": ["@", "I"], "t": "2026-08-19T13:30:00.102733966Z", "z": "C"}
EVENT = {
    "event_id": "sha256:a", "event_type": "market.trade.raw", "schema_version": 1, "source": "alpaca", "feed": "iex", "source_event_id": "23",
    "event_timestamp": TRADE["t"], "ingested_at": "2026-08-19T13:30:01Z", "trace_id": None, "payload": TRADE,
}


def changed(path, value):
    out = copy.deepcopy(EVENT)
    at = out
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    return json.dumps(out)


def judge(spark, values, symbols=("NVDA",), **kw):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset long")
    return validate.validate_trades(parse.parse_events(df), symbols, **kw).orderBy("kafka_offset")


def test_valid_trade_keeps_its_values(spark):
    row = judge(spark, [json.dumps(EVENT)]).first()
    assert row["reason_codes"] == [] and str(row["price"]) == "221.690000" and row["size"] == 5 and row["conditions"] == ["@", "I"]
    assert row["provider_timestamp_raw"].endswith("966Z") and row["provider_timestamp"].microsecond == 102733


CASES = [
    ("INVALID_EVENT_TYPE", ("event_type",), "market.quote.raw"), ("INVALID_EVENT_TYPE", ("payload", "T"), "q"), ("UNSUPPORTED_SCHEMA_VERSION", ("schema_version",), 2), ("MISSING_EVENT_ID", ("event_id",), "  "),
    ("MISSING_SOURCE_EVENT_ID", ("source_event_id",), None), ("MISSING_SOURCE", ("source",), ""), ("MISSING_FEED", ("feed",), None), ("SOURCE_EVENT_ID_MISMATCH", ("source_event_id",), "24"), ("SYMBOL_NOT_ALLOWED", ("payload", "S"), "nvda"),
    ("INVALID_PROVIDER_TRADE_ID", ("payload", "i"), "23"), ("INVALID_EXCHANGE", ("payload", "x"), " "), ("INVALID_CONDITIONS", ("payload", "c"), "@"), ("INVALID_TAPE", ("payload", "z"), None), ("INVALID_PRICE", ("payload", "p"), 0),
    ("INVALID_SIZE", ("payload", "s"), -1), ("INVALID_TIMESTAMP", ("payload", "t"), "2026-08-19T13:30:00.102733966"), ("TIMESTAMP_MISMATCH", ("payload", "t"), "2026-08-19T13:30:01Z"),
]


def test_every_rule_names_its_code(spark):
    rows = judge(spark, [changed(path, value) for _, path, value in CASES]).collect()
    for (code, path, _), row in zip(CASES, rows):
        assert code in row["reason_codes"], (code, path, row["reason_codes"])
    only = {"MISSING_SOURCE", "INVALID_TAPE", "INVALID_PRICE", "TIMESTAMP_MISMATCH", "SYMBOL_NOT_ALLOWED"}
    assert all(row["reason_codes"] == [code] for (code, *_), row in zip(CASES, rows) if code in only)


def test_broken_json_gets_all_codes_but_two(spark):
    bad, empty, none, null, lst, trailing = judge(spark, ["not-json", "", None, "null", "[]", '{"event_id":"a"} x']).collect()
    for row in (bad, empty, none):
        assert row["is_malformed"] and len(row["reason_codes"]) == 15 and not {"SOURCE_EVENT_ID_MISMATCH", "TIMESTAMP_MISMATCH"} & set(row["reason_codes"])
    assert not null["is_malformed"] and not lst["is_malformed"] and not trailing["is_malformed"] and trailing["event_id"] == "a"


@pytest.mark.parametrize("path, value, field, want", [(("payload", "p"), "1.5", "price", "1.500000"), (("payload", "p"), 1.23456789, "price", "1.234568"), (("payload", "p"), 12345678901234, "price", None), (("payload", "s"), 5.5, "size", None), (("event_id",), 5, "event_id", "5")])
def test_odd_values(spark, path, value, field, want):
    row = judge(spark, [changed(path, value)]).first()
    assert (None if row[field] is None else str(row[field])) == want and row["symbol"] == "NVDA"


def test_time_without_date_can_be_refused(spark):
    row = judge(spark, [changed(("payload", "t"), "13:30:00Z")], require_date=True).first()
    assert "INVALID_TIMESTAMP" in row["reason_codes"]


def test_empty_allow_list_refuses_all_and_metadata_may_be_missing(spark):
    row = judge(spark, [json.dumps(EVENT)], symbols=()).first()
    assert row["reason_codes"] == ["SYMBOL_NOT_ALLOWED"] and row["kafka_topic"] is None


def test_reason_counts(spark):
    df = spark.createDataFrame([(["INVALID_PRICE", "INVALID_SIZE"],), (["INVALID_PRICE"],)], "reason_codes array<string>")
    assert {r["reason_code"]: r["count"] for r in validate.reason_counts(df).collect()} == {"INVALID_PRICE": 2, "INVALID_SIZE": 1}


def ticks(spark, rows, feed="iex"):
    df = spark.createDataFrame([(f"2026-08-19 13:{t}", str(p), s, e) for t, p, s, e in rows], "t string, p string, size long, event_id string")
    return df.select(F.lit("NVDA").alias("symbol"), F.lit("alpaca").alias("source"), F.lit(feed).alias("feed"), F.col("t").cast("timestamp").alias("event_timestamp"), F.col("p").cast("decimal(18,6)").alias("price"), "size", "event_id")


def test_bars_from_trades_out_of_order(spark):
    bar = bars.aggregate_bars(ticks(spark, [("30:30", 105, 2, "b"), ("30:10", 100, 3, "a"), ("30:50", 102, 5, "c")])).first()
    assert [int(bar[c]) for c in ("open", "high", "low", "close", "volume", "trade_count")] == [100, 105, 100, 102, 10, 3] and str(bar["vwap"]) == "102.000000"
    assert bar["is_final"] and bar["timeframe"] == "1m" and bar["condition_policy"] == "all_valid_trades_v1"


def test_bars_do_not_depend_on_order_and_ties_go_by_id(spark):
    rows = [("30:10", 100 + i, 1, f"e{i}") for i in range(6)]
    one, two = (bars.aggregate_bars(ticks(spark, r).repartition(n)).first() for r, n in ((rows, 1), (rows[::-1], 3)))
    assert one == two and int(one["open"]) == 100 and int(one["close"]) == 105 and one["low"] <= one["vwap"] <= one["high"]


def test_no_volume_no_vwap_and_dedup(spark):
    bar = bars.aggregate_bars(parse.dedup_batch(ticks(spark, [("30:10", 100, 0, "a"), ("30:10", 100, 0, "a")]))).first()
    assert bar["volume"] == 0 and bar["vwap"] is None and bar["trade_count"] == 1


def test_event_id_is_the_digest_of_the_compact_array(spark):
    ident = ["alpaca", "iex", "market.trade.raw", "NVDA", "23", TRADE["t"]]
    row = envelope.build_envelopes(spark.createDataFrame([(json.dumps(TRADE),)], "value string"), "alpaca", "iex", F.lit("2026-08-19 13:30:01").cast("timestamp")).first()
    digest = hashlib.sha256(json.dumps(ident, separators=(",", ":")).encode()).hexdigest()
    assert digest == "82b5d1f2fb83283ea179d966bfe0a9c233638976b8f2dd817c0038d631f341f4"
    out = json.loads(row["value"])
    assert row["key"] == "NVDA" and row["event_id"] == out["event_id"] == "sha256:" + digest and out["payload"] == TRADE and out["trace_id"] is None and out["ingested_at"] == "2026-08-19T13:30:01Z"


def test_envelope_names_a_missing_key(spark):
    bad = {k: v for k, v in TRADE.items() if k != "t"}
    with pytest.raises(Exception, match="without t"):
        envelope.build_envelopes(spark.createDataFrame([(json.dumps(bad),)], "value string"), "alpaca", "iex", F.current_timestamp()).collect()


def test_messages(spark):
    df = spark.createDataFrame([(json.dumps(TRADE),), ('{"T":"subscription"}',), ('{"T":"error","code":406,"msg":"limit"}',), (json.dumps({k: v for k, v in TRADE.items() if k != "z"}),)], "value string")
    assert envelope.trade_messages(df).count() == 2
    assert df.filter(envelope.is_complete_trade(F.col("value"))).count() == 1
    assert [tuple(r) for r in envelope.control_errors(df).collect()] == [(406, "limit", 1)]


def test_pages(spark, tmp_path):
    trade = {k: v for k, v in TRADE.items() if k not in "TS"}
    landed = [{"symbol": "SMH", "page_no": 1, "trades": [trade | {"i": 1}], "next_page_token": "n"}, {"symbol": "SMH", "page_no": 2, "trades": [trade | {"i": 2}], "next_page_token": None}, {"symbol": "SPY", "page_no": 1, "trades": [trade], "next_page_token": "n"}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, landed)))
    pages = sources.landed_pages(spark, str(tmp_path))
    assert {r["symbol"]: (r["pages"], r["trades"], r["is_complete"]) for r in envelope.page_completeness(pages).collect()} == {"SMH": (2, 2, True), "SPY": (1, 1, False)}
    assert [(r["S"], r["T"], r["i"]) for r in envelope.pages_to_trades(pages.filter("symbol = 'SMH'")).orderBy("i").collect()] == [("SMH", "t", 1), ("SMH", "t", 2)]
    with pytest.raises(Exception, match="incomplete pages"):
        envelope.complete_pages_only(pages).collect()


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 10_001}, {"max_pages": 0}, {"start": "2026-08-19T13:30:00"}, {"end": "2026-08-19T13:00:00Z"}])
def test_page_bounds(spark, bad):
    good = {"limit": 10, "max_pages": 1, "start": "2026-08-19T13:30:00Z", "end": "2026-08-19T14:30:00+01:00"} | {"end": "2026-08-19T14:30:00Z"}
    sources.page_bounds(spark=spark, **good)
    with pytest.raises(ValueError):
        sources.page_bounds(spark=spark, **(good | bad))


def bar_rows(spark, *rows):
    base = {"symbol": "DEMO", "bar_start": "2026-08-20 13:30:00", "timeframe": "1m", "open": "100", "high": "101", "low": "99.5", "close": "100.5", "volume": 1200, "trade_count": 24, "vwap": "100.25", "source": "synthetic", "feed": "fixture", "is_final": True, "condition_policy": "all_valid_trades_v1"}
    names = BAR.fieldNames()
    df = spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], ", ".join(f"{n} {'long' if n in ('volume', 'trade_count') else 'boolean' if n == 'is_final' else 'string'}" for n in names))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in BAR.fields])


def test_digest_of_a_bar(spark):
    got = quality.digest(bar_rows(spark, {})).first()
    assert got["sha256"] == "1a1b804889fa1be4179c488b9de93b8b0812078941c780ae1f5949193d33ba38" and got["rows"] == 1
    assert quality.digest(bar_rows(spark, {"close": "100.6"})).first()["sha256"] != got["sha256"]
    a, b = bar_rows(spark, {}, {"symbol": "X"}), bar_rows(spark, {"symbol": "X"}, {})
    assert quality.unordered_digest(a).first() == quality.unordered_digest(b).first()


def test_constraints_and_keys(spark):
    df = bar_rows(spark, {}, {"close": "106"}, {"low": "-1", "symbol": "A"}, {"volume": -1, "symbol": "B"}, {"is_final": False, "symbol": "C"}, {"vwap": None, "symbol": "D"}, {"open": None, "symbol": "E"})
    got = {(r["symbol"], str(r["close"])): r["violations"] for r in quality.constraint_violations(df).collect()}
    assert got == {("DEMO", "106.000000"): ["HIGH_BELOW_OTHERS"], ("A", "100.500000"): ["LOW_NOT_POSITIVE"], ("B", "100.500000"): ["VOLUME_NEGATIVE"], ("C", "100.500000"): ["NOT_FINAL"], ("E", "100.500000"): ["OPEN_NULL"]}
    assert [r["rows"] for r in quality.duplicate_keys(df).collect()] == [2]
    s = quality.summary(df).first()
    assert (s["rows"], s["distinct_keys"]) == (7, 6)


def test_log_options():
    assert sources.log_options("h:1", "t")["failOnDataLoss"] == "true"
    with pytest.raises(ValueError):
        sources.log_options("h:1", "t", "middle")


def test_features_that_no_query_shows(spark):
    """Daylight saving, holidays, and the order-free digest row by row."""
    import xxhash

    from tidemark.operators import features

    times = [("2026-03-06 14:30:00", "REGULAR"), ("2026-03-09 13:30:00", "REGULAR"), ("2026-03-09 14:30:00", "REGULAR"), ("2026-03-06 13:30:00", "PRE_MARKET"), ("2026-07-03 15:00:00", "CLOSED"), ("2026-03-07 15:00:00", "CLOSED"), ("2026-03-09 20:30:00", "AFTER_HOURS")]
    df = spark.createDataFrame([(t,) for t, _ in times], "t string").select(F.col("t").cast("timestamp").alias("bar_start"))
    shut = spark.createDataFrame([("2026-07-03",)], "d string").select(F.to_date("d").alias("session_date"))
    got = {str(r["bar_start"]): r["session"] for r in features.with_session(df, shut).withColumn("bar_start", F.col("bar_start").cast("string")).collect()}
    assert got == dict(times)
    rows = bar_rows(spark, {"symbol": "A"}, {"symbol": "B", "vwap": None})
    lines = [r[0] for r in rows.select(quality.canonical_line()).collect()]
    want = sum((h := xxhash.xxh64(line.encode(), seed=42).intdigest()) - (h >> 63 << 64) for line in lines)
    assert tuple(quality.unordered_digest(rows).first()) == (2, str(want))


def test_rows_with_null_keys_are_never_duplicates(spark):
    from tidemark.operators import features

    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "x"), (4, None, None), (5, "b", "y"), (6, None, "y")], "id long, k string, h string")
    assert sorted(r["id"] for r in features.first_of_each(df, [["k"], ["h"]], ["id"]).collect()) == [1, 3, 4, 5]
