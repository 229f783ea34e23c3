"""The driver's contract, and the queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans import market

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"
PICKED = ["scan_raw_events", "parse_events", "build_envelopes", "historical_page_completeness", "validation_reasons", "minute_bars", "hour_bars", "finalized_bars", "bars_digest", "bar_constraint_violations", "upsert_latest_bars", "bar_returns", "technical_features", "as_of_lookup", "event_impact", "feed_reconciliation", "retention_counts"]


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(str(r[i]) for i in order) for r in found])


@pytest.mark.parametrize("name", PICKED)
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = db.sql(contract.oracle_sql()[name])
    got = contract.queries()[name](spark, SMALL)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(market.QUERIES) <= set(contract.queries())
    assert contract.entry(spark).count() == 1000


def test_plans_read_few_columns_and_join_nothing(spark):
    plan = market.QUERIES["minute_bars"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "Join" not in plan and "Python" not in plan


def test_as_of_takes_the_latest_known_and_nothing_later(spark):
    from tidemark.operators import joins

    points = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 5, 3)], "k string, t int, id int")
    facts = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("a", 6, "z")], "k string, u int, v string")
    got = {r["id"]: (r["u"], r["v"]) for r in joins.as_of(points, facts, ["k"], "t", "u", ["u", "v"]).collect()}
    assert got == {1: (5, "y"), 2: (None, None), 3: (None, None)}


def test_interval_join_is_half_open(spark):
    from tidemark.operators import joins

    left = spark.createDataFrame([(1, "2024-01-01 00:10:00", 0)], "k int, t string, id int").selectExpr("k", "cast(t as timestamp) t", "id")
    right = spark.createDataFrame([(1, f"2024-01-01 00:{m:02d}:00", m) for m in range(20)], "k int, u string, m int").selectExpr("k", "cast(u as timestamp) u", "m")
    assert sorted(r["m"] for r in joins.within(left, right, ["k"], "t", "u", 120, 180).collect()) == [8, 9, 10, 11, 12]


def test_weights_of_missing_components_go_to_the_others(spark):
    from tidemark.operators import features

    df = spark.createDataFrame([(0.5, None), (None, None), (-1.0, -0.5)], "a double, b double")
    got = [(r["score"], r["regime"]) for r in features.composite(df, {"a": 0.4, "b": 0.6}).collect()]
    assert got == [(0.5, "RISK_ON"), (None, None), (pytest.approx(-0.7), "RISK_OFF")]
