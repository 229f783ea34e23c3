"""Work that must not grow faster than the input: records are parsed once, windows are worked out once for a minute."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import impact, joins, timeline
from tidemark.plans import mapping, market

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 3, 4, 15, 0)


@pytest.mark.parametrize("name", ["impact_by_kind", "events_against_controls"])
def test_records_are_parsed_once(spark, monkeypatch, name):
    calls, parse, write, parsing = [], mapping.parse_events, timeline.written, []
    monkeypatch.setattr(mapping, "parse_events", lambda records: calls.append(1) or parse(records))
    monkeypatch.setattr(timeline, "written", lambda df: parsing.append("from_json" in df._jdf.queryExecution().optimizedPlan().toString()) or write(df))
    out = market.QUERIES[name](spark, SMALL)
    assert len(calls) == 1 and sum(parsing) == 1  # and what follows reads the table that was written
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("beside", [0, 20])
def test_events_of_a_minute_share_their_windows(spark, monkeypatch, beside):
    """With bars on whole minutes the time line is as long for fifty events as for one; with one beside it is exact too."""
    rng, lines, placed = random.Random(3), [], timeline.in_ranges
    monkeypatch.setattr(timeline, "in_ranges", lambda rows, *a: lines.append(rows.count()) or placed(rows, *a))
    bars = [("S", START + timedelta(minutes=m, seconds=beside * (m == 3)), 11.0 + m, 12.0 + m, 10 + m) for m in range(-7, 8)]
    bars = spark.createDataFrame(bars, "symbol string, bar_start timestamp, open double, close double, volume long")
    events = [(i, START + timedelta(minutes=2, microseconds=rng.randrange(1, 60_000_001))) for i in range(50)]
    got = impact.impact(spark.createDataFrame(events, "id int, event_time timestamp"), bars, ["S", "T"], (5,), market="S").collect()
    rows = {r["id"]: (r["pre_volume"], r["post_volume"]) for r in got}
    of = [(r["bar_start"], r["volume"]) for r in bars.collect()]
    five = timedelta(minutes=5)
    assert rows == {i: (sum(v for b, v in of if t - five <= b < t), sum(v for b, v in of if t <= b < t + five)) for i, t in events}
    if not beside:
        assert lines == [15 + 3 * 2]


def test_rows_near_events_meet_a_cell_and_not_its_events(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), START + timedelta(seconds=rng.randrange(-900, 900)), i % 7) for i in range(300)] + [("a", None, 1)]
    events = [(rng.choice(["a", "b"]), START + timedelta(seconds=rng.randrange(-900, 900))) for _ in range(12)] * 50
    df, near = spark.createDataFrame(rows, "k string, t timestamp, n int"), spark.createDataFrame(events, "k string, e timestamp")
    out = joins.without_near(df, near, ["k"], "t", "e", 30, 60)
    far = [r for r in rows if r[1] is None or not any(r[0] == k and e - timedelta(seconds=30) <= r[1] < e + timedelta(seconds=60) for k, e in events)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(far, key=key)
    assert joins.without_near(df, near, ["k"], "t", "e", 0, 0).count() == len(rows)


def test_quantiles_count_equal_values_first(spark, monkeypatch):
    lines, placed = [], timeline.in_ranges
    monkeypatch.setattr(timeline, "in_ranges", lambda rows, *a: lines.append(rows.count()) or placed(rows, *a))
    rows = spark.createDataFrame([("a", float(i % 3)) for i in range(90)], "g string, v double")
    assert impact.quantiles(rows, ["g"], "v", {"q": 0.5}).first()["q"] == 1.0 and lines == [3]
