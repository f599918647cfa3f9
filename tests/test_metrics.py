import datetime as dt

from helpers import curated

from playpulse.operators.engagement import build_daily_engagement, build_daily_revenue
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel
from playpulse.operators.retention import build_retention, player_activity_days, player_retention_flags
from playpulse.operators.sessions import build_sessions, session_facts


def test_sessions_split_at_midnight_and_error_flag(spark):
    ev = curated(spark, [
        dict(session_id="s1", event_time="2024-01-01 23:59:00", category="user"),
        dict(session_id="s1", event_time="2024-01-02 00:01:30", category="error"),
        dict(session_id="s2", event_time="2024-01-02 10:00:00", category="user"),
        dict(session_id="s3", event_time="2024-01-02 11:00:00", category="user"),
        dict(session_id="s3", event_time="2024-01-02 11:00:20.900", category="user"),
    ])
    rows = {(r.session_id, r.event_date): r for r in build_sessions(ev).collect()}
    assert len(rows) == 4
    a = rows[("s1", dt.date(2024, 1, 1))]
    b = rows[("s1", dt.date(2024, 1, 2))]
    assert (a.event_count, a.has_error, a.session_seconds) == (1, 0, 0)
    assert (b.event_count, b.has_error, b.session_seconds) == (1, 1, 0)
    assert rows[("s2", dt.date(2024, 1, 2))].session_seconds == 0
    assert rows[("s3", dt.date(2024, 1, 2))].session_seconds == 20  # whole seconds
    assert build_sessions(ev).columns[-1] == "session_seconds"


def test_revenue_rules(spark):
    ev = curated(spark, [
        dict(event_time="2024-01-01 10:00:00", category="business", amount=199, currency="USD"),
        dict(event_time="2024-01-01 10:05:00", category="business", amount=None, currency="USD"),
        dict(event_time="2024-01-01 10:06:00", category="business", amount=500, currency="EUR"),
        dict(event_time="2024-01-02 10:00:00", category="user", session_id="s9"),
    ])
    rev = {r.event_date: r.revenue_usd for r in build_daily_revenue(ev).collect()}
    assert rev == {dt.date(2024, 1, 1): 6.99}  # non-USD counted by default
    usd = {r.event_date: r.revenue_usd for r in build_daily_revenue(ev, currency="USD").collect()}
    assert usd == {dt.date(2024, 1, 1): 1.99}
    eng = {r.event_date: r.revenue_usd for r in build_daily_engagement(session_facts(ev), minimum_group_size=1).collect()}
    assert eng == {dt.date(2024, 1, 1): 6.99, dt.date(2024, 1, 2): 0.0}


def test_null_dimension_revenue_by_join_mode(spark):
    ev = curated(spark, [
        dict(event_time="2024-01-01 10:00:00", category="business", amount=300, platform=None),
    ])
    facts = session_facts(ev)
    safe = build_daily_engagement(facts, minimum_group_size=1).first()
    plain = build_daily_engagement(facts, minimum_group_size=1, null_safe_dimensions=False).first()
    assert safe.revenue_usd == 3.0 and plain.revenue_usd == 0.0
    sessions = build_sessions(ev)
    assert build_daily_engagement(sessions, ev, 1).first().revenue_usd == 3.0
    assert build_daily_engagement(sessions, ev, 1, null_safe_dimensions=False).first().revenue_usd == 0.0


def test_p95_and_engagement_counts(spark):
    rows = []
    for i in range(1, 21):  # 20 sessions lasting 1..20 s, two players
        rows.append(dict(session_id=f"s{i}", player_key=f"p{i % 2}", event_time="2024-01-01 10:00:00"))
        rows.append(dict(session_id=f"s{i}", player_key=f"p{i % 2}", event_time=f"2024-01-01 10:00:{i:02d}",
                         category="error" if i <= 5 else "user"))
    e = build_daily_engagement(session_facts(curated(spark, rows)), minimum_group_size=1).first()
    assert e.p95_session_seconds == 19
    assert (e.dau, e.sessions) == (2, 20)
    assert e.avg_session_seconds == 10.5
    assert e.crash_free_session_rate == 0.75
    assert build_daily_engagement(session_facts(curated(spark, rows)), minimum_group_size=3).count() == 0


def test_retention_flags_and_attribution(spark):
    ev = curated(spark, [
        dict(player_key="a", event_time="2024-01-01 09:00:00"),  # day 0
        dict(player_key="a", event_time="2024-01-02 09:00:00"),  # day 1
        dict(player_key="a", event_time="2024-01-08 09:00:00"),  # day 7
        dict(player_key="a", event_time="2024-01-31 09:00:00"),  # day 30
        dict(player_key="b", event_time="2023-12-30 09:00:00"),  # negative offset
        dict(player_key="b", event_time="2024-01-02 09:00:00", build="2.0"),  # day 1, later row
        dict(player_key="b", event_time="2024-01-02 08:00:00", build="1.0"),  # day 1, earliest
        dict(player_key="c", event_time="2024-01-02 09:00:00", signup_date=None),  # dropped
    ])
    flags = {(r.player_key, r.build): r for r in player_retention_flags(ev).collect()}
    assert set(flags) == {("a", "1.0"), ("b", "1.0")}
    a = flags[("a", "1.0")]
    assert (a.retained_d1, a.retained_d7, a.retained_d30) == (1, 1, 1)
    b = flags[("b", "1.0")]
    assert (b.retained_d1, b.retained_d7, b.retained_d30) == (1, 0, 0)
    days = player_activity_days(ev).filter("player_key = 'b'").orderBy("event_date").collect()
    assert [d.day_number for d in days] == [-2, 1]
    cohort = build_retention(ev, 1).collect()
    assert len(cohort) == 1
    c = cohort[0]
    assert (c.cohort_size, c.retained_d1_players, c.retained_d7_players, c.retained_d30_players) == (2, 2, 1, 1)
    assert (c.d1_retention, c.d7_retention) == (1.0, 0.5)
    assert build_retention(ev, 3).count() == 0


def test_funnel(spark):
    ev = curated(spark, [
        dict(player_key="a", category="progression", progression_01="L1", progression_status="start", event_time="2024-01-01 10:00:00"),
        dict(player_key="a", category="progression", progression_01="L1", progression_status="start", event_time="2024-01-01 10:01:00"),
        dict(player_key="a", category="progression", progression_01="L1", progression_status="complete", event_time="2024-01-01 10:02:00"),
        dict(player_key="b", category="progression", progression_01="L1", progression_status="fail", event_time="2024-01-01 10:03:00"),
        dict(player_key="b", category="progression", progression_01="L2", progression_status="complete", event_time="2024-01-01 10:04:00"),
        dict(player_key="b", category="progression", progression_01=None, progression_status="start", event_time="2024-01-01 10:05:00"),
    ])
    rows = {r.level: r for r in build_progression_funnel(ev, 0).collect()}
    assert set(rows) == {"L1", "L2"}  # null level dropped
    l1 = rows["L1"]
    assert (l1.players_started, l1.players_failed, l1.players_completed, l1.completion_rate) == (1, 1, 1, 1.0)
    l2 = rows["L2"]
    assert (l2.players_started, l2.players_completed, l2.completion_rate) == (0, 1, 0.0)
    assert build_progression_funnel(ev, 1).count() == 1


def test_economy(spark):
    ev = curated(spark, [
        dict(player_key="a", category="resource", flow_type="source", amount=100, virtual_currency="c", item_type="i", event_time="2024-01-01 10:00:00"),
        dict(player_key="a", category="resource", flow_type="sink", amount=30, virtual_currency="c", item_type="i", event_time="2024-01-01 10:01:00"),
        dict(player_key="b", category="resource", flow_type="sink", amount=None, virtual_currency="c", item_type="i", event_time="2024-01-01 10:02:00"),
        dict(player_key="b", category="resource", flow_type="trade", amount=999, virtual_currency="c", item_type="i", event_time="2024-01-01 10:03:00"),
    ])
    r = build_economy_flows(ev, 1).first()
    assert (r.supporting_players, r.currency_source, r.currency_sink, r.net_currency_flow) == (2, 100, 30, 70)
    assert build_economy_flows(ev, 3).count() == 0


def test_retention_tie_break_is_deterministic(spark):
    ev = curated(spark, [
        dict(player_key="a", event_time="2024-01-02 09:00:00", build="2.0", event_uuid="x1"),
        dict(player_key="a", event_time="2024-01-02 09:00:00", build="1.5", event_uuid="x2"),
        dict(player_key="a", event_time="2024-01-02 10:00:00", build="0.9", event_uuid="x3"),
    ])
    days = player_activity_days(ev).collect()
    assert [(d.build, d.day_number) for d in days] == [("1.5", 1)]
