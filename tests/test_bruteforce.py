"""Spark operators against plain-Python computations of the same definitions, on
random small event sets."""

import datetime as dt
import math
from collections import defaultdict

from helpers import curated
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playpulse.operators.engagement import build_daily_engagement
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel
from playpulse.operators.quality import quality_counts
from playpulse.operators.sessions import build_sessions, session_facts

DIMS = ("game_id", "event_date", "platform", "build", "country_code")

event = st.fixed_dictionaries({
    "player_key": st.sampled_from(["p0", "p1", "p2", "p3"]),
    "session_id": st.sampled_from(["s0", "s1", "s2"]),
    "day": st.integers(1, 3),
    "second": st.integers(0, 86399),
    "micros": st.sampled_from([0, 250000, 999999]),
    "category": st.sampled_from(["user", "error", "business", "progression", "resource", None]),
    "amount": st.one_of(st.none(), st.integers(0, 500)),
    "platform": st.sampled_from(["ios", "android", None]),
    "progression_01": st.sampled_from(["L1", "L2", None]),
    "progression_status": st.sampled_from(["start", "fail", "complete", "pause"]),
    "flow_type": st.sampled_from(["source", "sink", "trade"]),
    "event_uuid": st.sampled_from([f"u{i}" for i in range(12)] + [None]),
})


def _rows(events):
    out = []
    for e in events:
        t = dt.datetime(2024, 1, e["day"]) + dt.timedelta(seconds=e["second"], microseconds=e["micros"])
        out.append(dict(
            player_key=e["player_key"], session_id=e["session_id"], event_time=t,
            category=e["category"], amount=e["amount"], platform=e["platform"],
            progression_01=e["progression_01"], progression_status=e["progression_status"],
            flow_type=e["flow_type"], virtual_currency="c", item_type="i",
            event_uuid=e["event_uuid"],
        ))
    return out


def _dims(r):
    return ("g1", r["event_time"].date(), r["platform"], "1.0", "US")


def _close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12))


SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(event, min_size=1, max_size=40))
def test_sessions_and_engagement(spark, events):
    rows = _rows(events)
    ev = curated(spark, rows)
    sess = defaultdict(list)
    for r in rows:
        sess[_dims(r) + (r["player_key"], r["session_id"])].append(r)
    expected_sessions = {}
    for k, rs in sess.items():
        t0 = min(r["event_time"] for r in rs)
        t1 = max(r["event_time"] for r in rs)
        secs = max(0, math.floor(t1.timestamp()) - math.floor(t0.timestamp()))
        err = int(any(r["category"] == "error" for r in rs))
        expected_sessions[k] = (len(rs), err, secs)
    got = {
        (r.game_id, r.event_date, r.platform, r.build, r.country_code, r.player_key, r.session_id):
        (r.event_count, r.has_error, r.session_seconds)
        for r in build_sessions(ev).collect()
    }
    assert got == expected_sessions

    groups = defaultdict(list)
    for k, v in expected_sessions.items():
        groups[k[:5]].append((k[5], k[6], v))
    revenue = defaultdict(int)
    for r in rows:
        if r["category"] == "business":
            revenue[_dims(r)] += r["amount"] or 0
    eng = {tuple(getattr(r, c) for c in DIMS): r for r in build_daily_engagement(session_facts(ev), minimum_group_size=1).collect()}
    assert set(eng) == set(groups)
    for k, items in groups.items():
        secs = sorted(v[2] for _, _, v in items)
        e = eng[k]
        assert e.dau == len({p for p, _, _ in items})
        assert e.sessions == len({s for _, s, _ in items})
        assert _close(e.avg_session_seconds, sum(secs) / len(secs))
        assert e.p95_session_seconds == secs[math.ceil(0.95 * len(secs)) - 1]
        assert _close(e.crash_free_session_rate, 1.0 - sum(v[1] for _, _, v in items) / len(items))
        assert _close(e.revenue_usd, revenue[k] / 100.0)


@SETTINGS
@given(st.lists(event, min_size=1, max_size=40))
def test_funnel_and_economy(spark, events):
    rows = _rows(events)
    ev = curated(spark, rows)
    players = defaultdict(lambda: defaultdict(set))
    for r in rows:
        if r["category"] == "progression" and r["progression_01"] is not None:
            players[_dims(r) + (r["progression_01"],)][r["progression_status"]].add(r["player_key"])
    got = {tuple(getattr(r, c) for c in DIMS + ("level",)): r for r in build_progression_funnel(ev, 0).collect()}
    assert set(got) == set(players)
    for k, by_status in players.items():
        s, f, c = (len(by_status[x]) for x in ("start", "fail", "complete"))
        g = got[k]
        assert (g.players_started, g.players_failed, g.players_completed) == (s, f, c)
        assert _close(g.completion_rate, c / s if s else 0.0)

    flows = defaultdict(lambda: [set(), 0, 0])
    for r in rows:
        if r["category"] == "resource":
            f = flows[_dims(r)]
            f[0].add(r["player_key"])
            if r["flow_type"] == "source":
                f[1] += r["amount"] or 0
            elif r["flow_type"] == "sink":
                f[2] += r["amount"] or 0
    got = {tuple(getattr(r, c) for c in DIMS): r for r in build_economy_flows(ev, 0).collect()}
    assert set(got) == set(flows)
    for k, (ps, src, snk) in flows.items():
        g = got[k]
        assert (g.supporting_players, g.currency_source, g.currency_sink, g.net_currency_flow) == (len(ps), src, snk, src - snk)


@SETTINGS
@given(st.lists(event, min_size=1, max_size=40))
def test_gate_counts(spark, events):
    rows = _rows(events)
    ev = curated(spark, rows)
    by_day = defaultdict(list)
    for r in rows:
        by_day[r["event_time"].date()].append(r)
    got = {r.event_date: r for r in quality_counts(ev, ["event_date"]).collect()}
    assert set(got) == set(by_day)
    for d, rs in by_day.items():
        ids = defaultdict(int)
        for r in rs:
            ids[r["event_uuid"]] += 1
        missing = sum(1 for r in rs if r["event_uuid"] is None or r["category"] is None)
        g = got[d]
        assert g.row_count == len(rs)
        assert g.missing_required == missing
        assert g.duplicate_event_ids == sum(1 for n in ids.values() if n > 1)
        assert g.unsupported_categories == 0


retention_event = st.fixed_dictionaries({
    "player_key": st.sampled_from(["p0", "p1", "p2", "p3", "p4"]),
    "day": st.integers(0, 35),
    "second": st.integers(0, 86399),
    "signup": st.sampled_from([None, 0, 1, 2]),
    "build": st.sampled_from(["1.0", "2.0"]),
})


@SETTINGS
@given(st.lists(retention_event, min_size=1, max_size=40))
def test_cohort_retention(spark, events):
    from playpulse.operators.retention import build_retention, player_retention_flags

    base = dt.datetime(2024, 1, 1)
    rows = [dict(player_key=e["player_key"], build=e["build"],
                 event_time=base + dt.timedelta(days=e["day"], seconds=e["second"]),
                 signup_date=None if e["signup"] is None else (base + dt.timedelta(days=e["signup"])).date())
            for e in events]
    ev = curated(spark, rows)
    # the day's attributes: earliest event, exact time ties to the lowest (signup, build)
    first = {}
    for r in rows:
        if r["signup_date"] is None:
            continue
        k = (r["player_key"], r["event_time"].date())
        cand = (r["event_time"], r["signup_date"], r["build"])
        if k not in first or cand < first[k]:
            first[k] = cand
    flags = defaultdict(lambda: [0, 0, 0])
    for (p, day), (_, signup, build) in first.items():
        f = flags[(p, signup, build)]
        for i, n in enumerate((1, 7, 30)):
            if (day - signup).days == n:
                f[i] = 1
    got = {(r.player_key, r.signup_date, r.build): [r.retained_d1, r.retained_d7, r.retained_d30]
           for r in player_retention_flags(ev).collect()}
    assert got == dict(flags)
    cohorts = defaultdict(lambda: [0, 0, 0, 0])
    for (p, signup, build), f in flags.items():
        c = cohorts[(signup, build)]
        c[0] += 1
        for i in range(3):
            c[i + 1] += f[i]
    got = {(r.cohort_date, r.build): [r.cohort_size, r.retained_d1_players, r.retained_d7_players, r.retained_d30_players]
           for r in build_retention(ev, 1).collect()}
    assert got == dict(cohorts)


@SETTINGS
@given(st.lists(retention_event, min_size=1, max_size=40))
def test_eligible_retention(spark, events):
    import json

    from playpulse.operators.profile import eligible_retention, parse_lines

    base = dt.date(2024, 1, 1)
    lines, active, signups = [], defaultdict(set), {}
    for i, e in enumerate(events):
        if e["signup"] is None:
            continue
        day = base + dt.timedelta(days=e["day"])
        signup = base + dt.timedelta(days=e["signup"])
        lines.append(json.dumps({"event_uuid": str(i), "event_time": f"{day}T10:00:00Z", "user_id": e["player_key"],
                                 "session_id": "s", "category": "user", "signup_date": str(signup)}))
        active[e["player_key"]].add(day)
        signups[e["player_key"]] = min(signups.get(e["player_key"], signup), signup)
    if not lines:
        return
    last = max(d for ds in active.values() for d in ds)
    expected = []
    for n in (1, 7, 30):
        eligible = [p for p, s in signups.items() if (last - s).days >= n]
        retained = [p for p in eligible if signups[p] + dt.timedelta(days=n) in active[p]]
        expected += [len(eligible), len(retained)]
    r = eligible_retention(parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))).first()
    assert [r.eligible_d1, r.retained_d1, r.eligible_d7, r.retained_d7, r.eligible_d30, r.retained_d30] == expected
