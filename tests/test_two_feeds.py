"""Records of two feeds are parsed once."""

import pytest

from tidemark.operators import timeline
from tidemark.plans import mapping, market

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["settled_alerts", "alert_transitions", "alerts_by_status"])
def test_records_are_parsed_once(spark, monkeypatch, name):
    calls, parse, write, parsing = [], mapping.parse_events, timeline.written, []
    monkeypatch.setattr(mapping, "parse_events", lambda records: calls.append(1) or parse(records))
    monkeypatch.setattr(timeline, "written", lambda df: parsing.append("from_json" in df._jdf.queryExecution().optimizedPlan().toString()) or write(df))
    out = market.QUERIES[name](spark, SMALL)
    assert len(calls) == 1 and sum(parsing) == 1  # and what follows reads the table that was written
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_an_event_is_a_part_if_any_of_its_records_is(spark, monkeypatch):
    from tidemark.plans import research

    records = mapping.records_by_user
    monkeypatch.setattr(mapping, "records_by_user", lambda s, d: records(s, d).union(records(s, d).selectExpr("value", "offset", "1 - partition")))
    whole, feeds = research.two_feeds(spark, SMALL)
    assert {r["status"] for r in feeds.collect()} == {"MATCHED"} and whole.groupBy().sum("trade_count").first()[0] == 1_000
