"""The bar store's versions, crashes between its steps, retention; averages, digests, calendars and sketches."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.test_market import bar_rows

from tidemark.operators import averages, calendar, quality, sketches, timeline
from tidemark.streaming.store import BarStore

DAY = datetime(2024, 5, 6, 14, 30)


def some(spark, *days, close="100.5", symbol="A"):
    return bar_rows(spark, *[{"symbol": symbol, "bar_start": DAY + timedelta(days=d), "close": close} for d in days])


def held(store):
    return sorted((r["symbol"], (r["bar_start"] - DAY).days, float(r["close"])) for r in store.current().collect())


def test_batches_are_merged_and_corrected(spark, tmp_path):
    store = BarStore(spark, str(tmp_path), "r")
    assert held(store) == [] and store.merge() == 0
    store.write_batch(some(spark, 0, 1, 2), 0)
    assert held(store) == [("A", d, 100.5) for d in (0, 1, 2)]  # before any merge
    assert store.merge() == 1 and store.merge() == 1
    store.write_batch(some(spark, 1, 3, close="101"), 1)
    want = [("A", 0, 100.5), ("A", 1, 101.0), ("A", 2, 100.5), ("A", 3, 101.0)]
    assert held(store) == want
    store.merge()
    days = store.manifest()["days"]
    assert held(store) == want and len(days) == 4 and "version=000000000001" in days["2024-05-06"] and "version=000000000002" in days["2024-05-07"]
    store.vacuum()
    assert held(store) == want and not any(tmp_path.glob("log/*/batch=*")) and len(list(tmp_path.glob("versions/*.json"))) == 1
    store.write_batch(some(spark, 1, 3, close="101"), 1)  # a replay of a batch that is merged and gone
    assert held(store) == want


@pytest.mark.parametrize("step", ["_write_days", "_commit"])
def test_a_crash_leaves_the_version_before(spark, tmp_path, monkeypatch, step):
    store = BarStore(spark, str(tmp_path), "r")
    store.write_batch(some(spark, 0, 1), 0)
    store.merge()
    store.write_batch(some(spark, 1, 2, close="101"), 1)
    whole = getattr(BarStore, step)

    def crash(self, *given):
        if step == "_write_days":
            whole(self, *given)
        raise RuntimeError("lost")

    monkeypatch.setattr(BarStore, step, crash)
    with pytest.raises(RuntimeError):
        store.merge()
    want = [("A", 0, 100.5), ("A", 1, 101.0), ("A", 2, 101.0)]
    assert held(store) == want and store.manifest()["version"] == 1
    monkeypatch.setattr(BarStore, step, whole)
    assert store.merge() == 2 and held(store) == want
    store.vacuum()
    assert held(store) == want


def test_days_expire_but_for_windows(spark, tmp_path):
    store = BarStore(spark, str(tmp_path), "r")
    store.write_batch(some(spark, 0, 1, 2, 3).unionByName(some(spark, 1, symbol="B")), 0)
    kept = spark.createDataFrame([("B", DAY + timedelta(days=1), DAY + timedelta(days=1, minutes=1))], "symbol string, start timestamp, end timestamp")
    assert store.expire(date(2024, 5, 10), 2, kept) == {"2024-05-06": 1, "2024-05-07": 2}
    assert held(store) == [("A", 2, 100.5), ("A", 3, 100.5), ("B", 1, 100.5)]
    assert store.expire(date(2024, 5, 30), 2) == {"2024-05-07": 1, "2024-05-08": 1, "2024-05-09": 1} and held(store) == []


def test_a_second_writer_is_refused(spark, tmp_path):
    store = BarStore(spark, str(tmp_path), "r")
    store.write_batch(some(spark, 0), 0)
    store.merge()
    with pytest.raises(ValueError, match="another writer"):
        store._commit(1, {}, [])


def series(spark, n, parts=3):
    rng = random.Random(4)
    rows = [("A" if i % 10 else "B", "s", "f", DAY + timedelta(minutes=i), 100 + rng.gauss(0, 5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "symbol string, source string, feed string, bar_start timestamp, close double").repartition(parts)


@pytest.mark.parametrize("n", [1, 2, 20, 500])
def test_averages_equal_the_recurrence_from_the_first_bar(spark, n):
    rows, df = series(spark, 6_000)
    got = {r["bar_start"]: r["ema"] for r in averages.whole_averages(df, {"ema": n}, ranges=5).collect()}
    a = 2 / (n + 1)
    for symbol in ("A", "B"):
        y = None
        for _, _, _, t, x in [r for r in rows if r[0] == symbol]:
            y = x if y is None else (1 - a) * y + a * x
            assert got[t] == pytest.approx(y, rel=1e-9)


def test_tree_digests_depend_on_rows_alone(spark):
    bars = bar_rows(spark, *[{"symbol": "A" if i % 3 else "B", "bar_start": DAY + timedelta(minutes=i)} for i in range(50)])
    rows = lambda df: sorted(map(tuple, df.select("symbol", "rows", "sha256").collect()))
    small = rows(quality.tree_digest(bars, "symbol", block=4))
    assert small == rows(quality.tree_digest(bars.repartition(7), "symbol", block=4)) and [r[1] for r in small] == [33, 17]
    assert rows(quality.tree_digest(bars, "symbol")) == rows(quality.digest(bars, "symbol")) != small
    changed = bars.withColumn("volume", F.when(F.col("bar_start") == F.lit(DAY + timedelta(minutes=9)), 999).otherwise(F.col("volume")))
    assert [a == b for a, b in zip(small, rows(quality.tree_digest(changed, "symbol", block=4)))] == [True, False]


def test_sessions_follow_the_calendar_and_the_clocks(spark):
    days = calendar.intervals(spark, "2024-03-01", "2024-04-05", ["2024-03-29"], ["2024-03-28"])
    utc = {"2024-03-08 14:29": "PRE_MARKET", "2024-03-08 14:30": "REGULAR", "2024-03-08 21:00": "AFTER_HOURS", "2024-03-11 13:30": "REGULAR", "2024-03-11 13:29": "PRE_MARKET", "2024-03-28 16:59": "REGULAR", "2024-03-28 17:00": "AFTER_HOURS", "2024-03-28 21:00": "CLOSED", "2024-03-29 15:00": "CLOSED", "2024-03-30 15:00": "CLOSED", "2024-04-01 03:00": "CLOSED"}
    bars = spark.createDataFrame([(t,) for t in utc], "t string").select("t", F.to_timestamp("t").alias("bar_start"))
    got = {r["t"]: (r["session"], str(r["session_date"])) for r in calendar.in_sessions(bars, days).collect()}
    assert {t: s for t, (s, _) in got.items()} == utc and got["2024-04-01 03:00"][1] == "2024-03-31"


def test_sketches_merge_over_batches_and_groups(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.randrange(6), rng.expovariate(0.01)) for _ in range(20_000)]
    log = sketches.SketchLog(spark, str(tmp_path / "log"), ["g"], "v")
    for n in range(6):
        batch = spark.createDataFrame([r for r in rows if r[1] == n], "g string, n int, v double")
        for _ in range(1 + n % 2):  # some batches are tried twice
            log.write_batch(batch, n)
    for by in (["g"], []):
        for r in sketches.told(log.read(by), {"p50": 0.5, "p95": 0.95}).collect():
            own = sorted(v for g, _, v in rows if not by or g == r["g"])
            assert r["events"] == len(own)
            for share, q in ((0.5, r["p50"]), (0.95, r["p95"])):
                assert abs(sum(v <= q for v in own) / len(own) - share) <= 2 * sketches.rank_error()
    assert timeline.written(log.read(["g"])).count() == 2
