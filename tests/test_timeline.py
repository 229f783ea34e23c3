"""Running values by ranges, against plain loops; hot keys; controls and windows of events."""

import random
from datetime import datetime, timedelta
from statistics import quantiles

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, impact, joins, timeline

START = datetime(2024, 3, 4, 15, 0)


def test_running_values_equal_a_loop(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot", "hot", "hot"]), rng.randrange(200), rng.choice([None, rng.randrange(50)]), i) for i in range(1_500)]
    df = spark.createDataFrame(rows, "k string, t int, v int, i int")
    out = timeline.running(timeline.in_ranges(df, ["k"], ["t", "i"], 7), ["k"], ["t", "i"], sums=["v"], lasts=["v"], nexts=["v"], maxima=["v"])
    got = {r["i"]: (r["sum_v"], r["last_v"], r["next_v"], r["max_v"]) for r in out.collect()}
    want = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[3]))
        for n, r in enumerate(own):
            upto, onward = [x[2] for x in own[: n + 1] if x[2] is not None], [x[2] for x in own[n:] if x[2] is not None]
            want[r[3]] = (sum(upto) if upto else None, upto[-1] if upto else None, onward[0] if onward else None, max(upto) if upto else None)
    assert got == want


def test_a_hot_key_and_a_hot_moment_lie_in_even_ranges(spark):
    """Nine tenths of the rows have one key, half of these one time; no range has more than a few times its share."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("t"), "id")
    placed = timeline.in_ranges(df, ["k"], ["t"], 16)
    sizes = [r["count"] for r in placed.groupBy(timeline.RANGE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16
    out = timeline.running(placed, ["k"], ["t"], sums=["id"])
    assert out.filter("k = -1").agg(F.max("sum_id")).first()[0] == sum(i for i in range(20_000) if i % 10)


def test_as_of_over_ranges_equals_a_loop(spark):
    rng = random.Random(9)
    facts = [(rng.choice(["hot"] * 9 + ["x", None]), rng.choice([None, rng.randrange(300)]), rng.randrange(9)) for _ in range(800)]
    points = [(rng.choice(["hot"] * 9 + ["x", None, "none"]), rng.randrange(-5, 310), i) for i in range(700)]
    out = joins.as_of(spark.createDataFrame(points, "k string, t int, id int"), spark.createDataFrame(facts, "k string, u int, v int"), ["k"], "t", "u", ["u", "v"], ranges=9)
    got = {r["id"]: (r["u"], r["v"]) for r in out.collect()}
    assert got == {i: max(((u, v) for key, u, v in facts if key == k and u is not None and u <= t), default=(None, None)) for k, t, i in points}


def test_plans_have_no_window_over_a_key_alone(spark):
    points, facts = spark.createDataFrame([("a", 5, 1)], "k string, t int, id int"), spark.createDataFrame([("a", 2, "x")], "k string, u int, v string")
    plan = joins.as_of(points, facts, ["k"], "t", "u", ["u", "v"])._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [" in line]
    assert len(over) == 2 and sum("__range" in line.split("], [")[1] for line in over) == 1  # rows by range and key; what is by key alone has a row a range


def test_quantiles_are_exact(spark):
    rng = random.Random(2)
    rows = [("a", rng.gauss(0, 1)) for _ in range(501)] + [("b", float(i % 3)) for i in range(50)] + [("b", None), (None, 4.0)]
    got = {r["g"]: (r["p25"], r["p50"], r["p95"]) for r in impact.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p25": 0.25, "p50": 0.5, "p95": 0.95}).collect()}
    for g in ("a", "b"):
        cuts = quantiles([v for k, v in rows if k == g and v is not None], n=20, method="inclusive")
        assert got[g] == pytest.approx((cuts[4], cuts[9], cuts[18]))
    assert got[None] == (4.0, 4.0, 4.0)


def bars_of(spark, minutes, prices):
    rows = [("S", START + timedelta(minutes=m), p, p * 1.01, 10 + m) for m, p in zip(minutes, prices)]
    return spark.createDataFrame(rows, "symbol string, bar_start timestamp, open double, close double, volume long")


def test_windows_are_half_open_and_empty_sides_are_null(spark):
    bars = bars_of(spark, [-5, -1, 0, 4, 5], [1.0, 2.0, 3.0, 4.0, 5.0])
    events = spark.createDataFrame([(1, START), (2, START + timedelta(minutes=10)), (3, START + timedelta(days=9))], "id int, event_time timestamp")
    got = {r["id"]: r for r in impact.impact(events, bars, ["S", "T"], (5,), market="S").collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one["pre_bars"], one["post_bars"], one["pre_volume"], one["post_volume"]) == (2, 2, 14, 24)
    assert one["pre_return"] == pytest.approx(2.02 / 1 - 1) and one["post_return"] == pytest.approx(4.04 / 3 - 1) and one["excess_return"] == 0 and one["coverage"] == 0.4
    assert (two["pre_bars"], two["post_bars"], two["post_return"], two["post_volatility"]) == (1, 0, None, None)


def test_controls_keep_local_time_and_stay_clear_of_events(spark):
    """Across the change of clocks on 10 March 2024 a control keeps New York's minute; weeks with an event near are out."""
    events = spark.createDataFrame([("e", START), ("f", START + timedelta(days=7, hours=-1, minutes=3))], "id string, event_time timestamp")
    first, last = F.lit(datetime(2024, 2, 20)), F.lit(datetime(2024, 3, 26))
    got = {(r["event_id"], r["event_time"]) for r in impact.controls(events, 9, 3, 300, 300, "s", first, last).collect()}
    assert {t for e, t in got if e == "e"} == {START - timedelta(days=7), START + timedelta(days=14, hours=-1), START + timedelta(days=21, hours=-1)}
    assert {t for e, t in got if e == "f"} == {START + timedelta(days=d, hours=-1, minutes=3) for d in (14, 21)} | {START + timedelta(days=-7, minutes=3)}
    few = impact.controls(events, 1, 3, 300, 300, "s", first, last).collect()
    assert len(few) == 2 and few == impact.controls(events, 1, 3, 300, 300, "s", first, last).collect()


def test_first_of_each_reads_its_input_once(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (4, None, None), (5, "b", "y"), (6, None, None)], "id int, k string, c string")
    out = features.first_of_each(rows, [["k"], ["c"]], ["id"])
    assert sorted(r["id"] for r in out.collect()) == [1, 4, 5, 6]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
