import hashlib
import json

import pytest
from helpers import curated

from playpulse.operators import profile as P
from playpulse.operators.quality import (
    QualityGateError,
    failures,
    quality_gate,
    quality_gate_by_date,
    run_quality_gate,
)


def _gate_events(spark):
    return curated(spark, [
        dict(event_uuid="a", event_time="2024-01-02 10:00:00"),
        dict(event_uuid="a", event_time="2024-01-02 10:00:00"),
        dict(event_uuid="a", event_time="2024-01-02 10:00:00"),
        dict(event_uuid="b", event_time="2024-01-02 10:00:00", player_key=None),
        dict(event_uuid="c", event_time="2024-01-02 10:00:00", category="telemetry"),
        dict(event_uuid="d", event_time="2024-01-02 10:00:00", category=None),
        dict(event_uuid="e", event_time="2024-01-03 10:00:00"),
    ])


def test_gate_counts_and_messages(spark):
    ev = _gate_events(spark)
    g = {r.check_name: r for r in quality_gate(ev, "2024-01-02").collect()}
    assert g["row_count"].observed == 6 and g["row_count"].passed
    assert g["missing_required"].observed == 2  # null key, null category
    assert g["duplicate_event_ids"].observed == 1  # one id seen three times
    assert g["unsupported_categories"].observed == 1  # null category is not counted here
    assert failures(quality_gate(ev, "2024-01-02")) == [
        "2 rows have missing required fields",
        "1 duplicate event identifiers were found",
        "1 unsupported categories were found",
    ]
    with pytest.raises(QualityGateError) as e:
        run_quality_gate(ev, "2024-01-02")
    assert len(e.value.messages) == 3
    assert run_quality_gate(ev, "2024-01-03") == 1


def test_gate_empty_day(spark):
    ev = _gate_events(spark)
    assert failures(quality_gate(ev, "2024-02-01")) == ["No events found for 2024-02-01"]


def test_gate_by_date_with_calendar(spark):
    ev = _gate_events(spark)
    rows = quality_gate_by_date(ev, "2024-01-01", "2024-01-03").collect()
    assert len(rows) == 12
    bad = failures(quality_gate_by_date(ev, "2024-01-01", "2024-01-03"))
    assert bad[0] == "No events found for 2024-01-01"
    assert len(bad) == 4


def _line(**kw):
    d = {"event_uuid": "u", "event_time": "2024-01-01T10:00:00Z", "user_id": "p1",
         "session_id": "s1", "category": "user", "signup_date": "2024-01-01",
         "country_code": "US"}
    d.update(kw)
    return json.dumps(d)


def _parsed(spark, lines):
    return P.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_profile_validity_and_duplicates(spark):
    lines = [
        _line(event_uuid="a"), _line(event_uuid="a"), _line(event_uuid="a"),
        _line(event_uuid="b", category="ERROR", session_id="s2"),
        "{broken", "",
        _line(event_uuid="c", category="unknown"),
        _line(event_uuid=""),
        _line(event_uuid="d", event_time="not a time"),
        _line(event_uuid="e", signup_date=None),
        _line(event_uuid="f", user_id=None),
        _line(event_uuid="g", category="business", amount=250),
        _line(event_uuid="h", category="business", amount="12"),
    ]
    parsed = _parsed(spark, lines)
    p = P.file_profile(parsed).first()
    assert (p.events, p.valid_events, p.invalid_events) == (13, 6, 7)
    assert p.duplicate_event_ids == 2  # occurrences, not ids
    assert (p.players, p.sessions) == (1, 2)
    assert P.total_revenue(parsed).first().revenue_usd == 2.5
    cats = [(r.category, r.events) for r in P.category_counts(parsed).collect()]
    assert cats == [("business", 2), ("error", 1), ("user", 3)]
    e = P.error_session_rate(parsed).first()
    assert (e.error_sessions, e.sessions, e.error_session_rate_percent) == (1, 2, 50.0)


def test_eligible_retention(spark):
    lines = [
        _line(event_uuid="1", user_id="a", signup_date="2024-01-01", event_time="2024-01-01T10:00:00Z"),
        _line(event_uuid="2", user_id="a", signup_date="2024-01-03", event_time="2024-01-02T10:00:00Z"),
        _line(event_uuid="3", user_id="a", signup_date="2024-01-01", event_time="2024-01-08T10:00:00Z"),
        _line(event_uuid="4", user_id="b", signup_date="2024-01-01", event_time="2024-01-11T10:00:00Z"),
    ]
    r = P.eligible_retention(_parsed(spark, lines)).first()
    # last day 01-11: both cohorts (01-01) are 10 days old -> eligible for D1 and D7, not D30
    assert (r.eligible_d1, r.eligible_d7, r.eligible_d30) == (2, 2, 0)
    assert (r.retained_d1, r.retained_d7, r.retained_d30) == (1, 1, 0)
    assert (r.d1_retention_percent, r.d7_retention_percent, r.d30_retention_percent) == (50.0, 50.0, 0.0)


def test_levels_keys_privacy(spark):
    lines = []
    for lvl, starts, completes in [("L1", 4, 1), ("L2", 4, 3), ("L3", 2, 0), ("L4", 4, 1)]:
        lines += [_line(event_uuid=f"{lvl}s{i}", category="progression", progression_01=lvl,
                        progression_status="start") for i in range(starts)]
        lines += [_line(event_uuid=f"{lvl}c{i}", category="progression", progression_01=lvl,
                        progression_status="complete") for i in range(completes)]
    lines.append(_line(event_uuid="nolevel", category="progression", progression_status="start"))
    lines.append(_line(event_uuid="caps", category="progression", progression_01="L1", progression_status="Start"))
    parsed = _parsed(spark, lines)
    counts = {r.level: (r.starts, r.completions) for r in P.level_counts(parsed).collect()}
    assert counts["unknown"] == (1, 0) and counts["L1"] == (4, 1)  # status is exact-case
    hard = [(r.level, r.completion_rate) for r in P.hardest_levels(parsed, 3).collect()]
    assert hard == [("L1", 25.0), ("L4", 25.0), ("L2", 75.0)]  # ties by level name
    keys = P.sample_player_keys(parsed, "salt").orderBy("sample_rank").collect()
    assert [k.sample_rank for k in keys] == [1, 2, 3, 4, 5]
    assert keys[0].player_key == hashlib.sha256(b"saltp1").hexdigest()
    priv = P.suppressed_privacy_groups(parsed, 20).first()
    assert (priv.privacy_groups, priv.privacy_groups_suppressed) == (1, 0)
    priv = P.suppressed_privacy_groups(parsed, 100).first()
    assert priv.privacy_groups_suppressed == 1


def test_summary_row(spark):
    lines = [_line(event_uuid=str(i), session_id=f"s{i % 3}", category="error" if i == 0 else "user") for i in range(6)]
    s = P.validation_summary(_parsed(spark, lines), "salt", 1).first()
    assert s.events == 6 and s.valid_events == 6 and s.category_counts == {"error": 1, "user": 5}
    assert s.error_session_rate_percent == 33.33
    assert len(s.sample_hashed_player_keys) == 5
    assert s.hardest_levels == []
    assert s.privacy_threshold == 1


def test_profile_files_gzip_with_bad_line(spark, tmp_dir):
    import gzip
    import os

    from playpulse.plans.validate import profile_files

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with gzip.open(os.path.join(src, "part-0.json.gz"), "wt") as f:
        f.write(_line(event_uuid="a") + "\n" + "{oops\n" + _line(event_uuid="b", category="business", amount=120) + "\n")
    out = os.path.join(tmp_dir, "summary")
    row = profile_files(spark, src, "salt", 1, out).first()
    assert (row.events, row.valid_events, row.invalid_events, row.revenue_usd) == (3, 2, 1, 1.2)
    written = spark.read.json(out).first()
    assert written.events == 3


def test_summary_of_a_file_without_valid_rows(spark):
    s = P.validation_summary(_parsed(spark, ["{broken", "", _line(category="unknown")]), "salt", 20).first()
    assert (s.events, s.valid_events, s.invalid_events, s.players, s.sessions) == (3, 0, 3, 0, 0)
    assert s.category_counts == {} and s.hardest_levels == [] and s.sample_hashed_player_keys == []
    assert (s.d1_retention_percent, s.error_session_rate_percent, s.revenue_usd) == (0.0, 0.0, 0.0)
    assert (s.privacy_groups_suppressed, s.privacy_threshold) == (0, 20)
