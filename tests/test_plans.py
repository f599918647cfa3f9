"""Properties of the physical plans that the scale design relies on."""

import os
import re

import pytest
from helpers import curated

from playpulse.operators.engagement import build_daily_engagement
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel
from playpulse.operators.profile import parse_lines, validation_summary
from playpulse.operators.quality import quality_gate
from playpulse.operators.retention import build_retention
from playpulse.operators.sessions import session_facts
from playpulse.sources.tables import read_table_path, write_table
from playpulse.streaming.ingest import ingest


def plan(df) -> str:
    """The final adaptive plan, as text."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    rows = [dict(event_time=f"2024-01-0{1 + i % 3} 1{i % 10}:00:00", player_key=f"p{i % 4}",
                 session_id=f"s{i % 5}", category=["user", "business", "progression", "resource"][i % 4],
                 progression_01="L1", progression_status="start", amount=i, flow_type="source",
                 virtual_currency="c", item_type="i") for i in range(60)]
    write_table(curated(spark, rows), "game_events", path, "static")
    return read_table_path(spark, path, "game_events")


def test_no_pairwise_joins_anywhere(spark, events):
    for df in (build_daily_engagement(session_facts(events), minimum_group_size=1), build_retention(events, 1),
               build_progression_funnel(events, 1), build_economy_flows(events, 1)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_json_parsed_once_per_message(spark):
    raw = spark.createDataFrame([('{"event_uuid":"a","event_time":"2024-01-01T00:00:00Z","game_id":"g",'
                                  '"user_id":"u","session_id":"s","category":"user"}',)], "value string")
    p = plan(ingest(raw, "salt"))
    assert p.count("from_json(") == 1


def test_retention_first_step_is_hash_aggregate(spark, events):
    p = plan(build_retention(events, 1))
    lines = [line for line in p.split("\n") if "min(event_time" in line]
    assert lines and all("HashAggregate" in line for line in lines)


def test_p95_from_histogram_not_sketches(spark, events):
    p = plan(build_daily_engagement(session_facts(events), minimum_group_size=1))
    assert "percentile_approx" not in p
    windows = [line for line in p.split("\n") if "Window [" in line]
    assert windows
    for line in windows:  # running counts per dimension group over (value, count) rows
        part = re.search(r"\[([^\]]*)\], \[session_seconds", line)
        assert part is None or "player_key" not in part.group(1)
    hist = [line for line in p.split("\n") if "HashAggregate" in line and "session_seconds" in line
            and "keys=" in line]
    assert any("session_seconds" in re.search(r"keys=\[([^\]]*)\]", line).group(1) for line in hist)


def test_one_day_gate_prunes_partitions(spark, events):
    p = plan(quality_gate(events, "2024-01-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", p)


def test_summary_has_no_repeated_subqueries(spark, tmp_dir):
    lines = spark.createDataFrame([('{"event_uuid":"a","event_time":"2024-01-01T00:00:00Z","user_id":"u",'
                                    '"session_id":"s","category":"user","signup_date":"2024-01-01"}',)], "value string")
    path = os.path.join(tmp_dir, "parsed")
    parse_lines(lines).write.parquet(path)
    p = plan(validation_summary(spark.read.parquet(path), "salt", 1))
    assert p.count("Subquery subquery") <= 2  # the one last-day value (and its reuse)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
