"""Cohorts kept by activity masks: equal to a full rebuild, and only what a day can reach is touched."""

import datetime as dt
import os
import random

import pytest
from helpers import curated

from playpulse.operators.retention import (
    activity_change,
    activity_of_days,
    build_retention,
    merge_activity,
    player_activity_days,
    retention_of_activity,
)
from playpulse.plans import build as build_module
from playpulse.plans.build import TABLES, build_and_write
from playpulse.sources.tables import read_table_path

FIRST = dt.date(2024, 1, 1)


def events_of(spark, seed, n=300, span=45):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        day = FIRST + dt.timedelta(days=r.randrange(span))
        p = r.randrange(40)
        rows.append(dict(
            event_uuid=f"{seed}-{i}", event_time=dt.datetime.combine(day, dt.time(r.randrange(24), r.randrange(60))), player_key=f"p{p}", session_id=f"s{p}",
            platform=r.choice(["ios", "android", None]), build=r.choice(["1", "2"]), signup_date=r.choice([None, *[FIRST + dt.timedelta(days=p % 9 + k) for k in (-2, 0, 0, 0)]]),
        ))
    return curated(spark, rows)


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def test_masks_give_the_cohorts(spark):
    events = events_of(spark, 1)
    got = retention_of_activity(activity_of_days(player_activity_days(events)), 2)
    assert rows_of(got) == rows_of(build_retention(events, 2)) != []


@pytest.mark.parametrize("seed", range(3))
def test_a_replaced_day_merges_into_the_masks(spark, seed):
    """Days change in every way: rows come, go and take other attributes, in and outside of the first month."""
    r = random.Random(seed)
    days = player_activity_days(events_of(spark, seed, 200)).cache()
    other = player_activity_days(events_of(spark, seed + 50, 200))
    taken = [FIRST + dt.timedelta(days=r.randrange(45)) for _ in range(6)]
    inside = days["event_date"].isin(taken)
    old, new = days.where(inside), other.where(other["event_date"].isin(taken))
    merged = merge_activity(activity_of_days(days), activity_change(old, new))
    want = activity_of_days(days.where(~inside).unionByName(new))
    assert rows_of(merged) == rows_of(want)
    assert activity_change(old, old).count() == 0


def paths_in(folder):
    return {t: os.path.join(folder, t) for t in TABLES}


def cohorts_of(spark, paths):
    return read_table_path(spark, paths["cohort_retention"], "cohort_retention")


def test_days_one_by_one_equal_a_full_build(spark, tmp_dir):
    first, late = events_of(spark, 7, 250), events_of(spark, 8, 60)
    paths = paths_in(tmp_dir)
    build_and_write(spark, first.where("event_date < DATE '2024-01-20'"), paths, 2)
    for a, b in (("2024-01-20", "2024-01-31"), ("2024-02-01", "2024-02-05"), ("2024-02-04", "2024-02-20")):
        build_and_write(spark, first, paths, 2, a, b)
    everything = first.unionByName(late)
    for a, b in (("2024-01-05", "2024-01-09"), ("2024-01-01", "2024-02-20")):
        build_and_write(spark, everything, paths, 2, a, b)
    assert rows_of(cohorts_of(spark, paths)) == rows_of(build_retention(everything, 2)) != []
    stored = read_table_path(spark, paths["player_sessions"] + "_activity", "player_activity")
    assert rows_of(stored) == rows_of(activity_of_days(player_activity_days(everything)))


def test_only_cohorts_of_changed_players_are_touched(spark, tmp_dir, monkeypatch):
    rows = [dict(event_uuid=f"e{p}{d}", event_time=f"2024-01-{d:02d} 10:00:00", player_key=f"p{p}", signup_date=dt.date(2024, 1, p)) for p in (1, 2, 3) for d in (3, 4)]
    events = curated(spark, rows)
    paths = paths_in(tmp_dir)
    build_and_write(spark, events, paths, 1)
    files = {p: sorted(os.listdir(os.path.join(paths["cohort_retention"], p))) for p in os.listdir(paths["cohort_retention"]) if "=" in p}
    plans = []
    merge = build_module.merge_activity
    monkeypatch.setattr(build_module, "merge_activity", lambda a, c: plans.append(a._jdf.queryExecution().executedPlan().toString()) or merge(a, c))
    more = events.unionByName(curated(spark, [dict(event_uuid="new", event_time="2024-01-09 10:00:00", player_key="p2", signup_date=dt.date(2024, 1, 2))]))
    built = build_and_write(spark, more, paths, 1, "2024-01-09", "2024-01-09")
    assert built.cohorts == {dt.date(2024, 1, 2)} and built.days == {dt.date(2024, 1, 9)}
    assert len(plans) == 1 and "signup_date" in plans[0].split("PartitionFilters: [")[1].split("]")[0] and "player_days" not in plans[0].replace("player_sessions_days", "player_days")
    after = {p: sorted(os.listdir(os.path.join(paths["cohort_retention"], p))) for p in files}
    assert [p for p in files if files[p] != after[p]] == ["cohort_date=2024-01-02"]
    assert rows_of(cohorts_of(spark, paths)) == rows_of(build_retention(more, 1))
    again = build_and_write(spark, more, paths, 1, "2024-01-04", "2024-01-09")
    assert again.cohorts == set() and len(plans) == 1  # nothing changed: no mask is read


def test_a_run_that_ended_in_between_is_made_good(spark, tmp_dir, monkeypatch):
    first, more = events_of(spark, 11, 120), events_of(spark, 12, 120)
    paths, everything = paths_in(tmp_dir), first.unionByName(more)
    build_and_write(spark, first, paths, 1)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(build_module, "merge_activity", fail)
    with pytest.raises(RuntimeError):
        build_and_write(spark, everything, paths, 1, "2024-01-01", "2024-02-20")
    monkeypatch.undo()
    built = build_and_write(spark, everything, paths, 1, "2024-01-10", "2024-01-10")
    assert built.cohorts is None
    assert rows_of(cohorts_of(spark, paths)) == rows_of(build_retention(everything, 1))


def test_a_table_without_masks_gets_them(spark, tmp_dir):
    """Tables built before masks were kept: the first ranged run makes them from the stored days."""
    import shutil

    events, paths = events_of(spark, 13, 100), paths_in(tmp_dir)
    build_and_write(spark, events, paths, 1)
    shutil.rmtree(paths["player_sessions"] + "_activity")
    assert build_and_write(spark, events, paths, 1, "2024-01-10", "2024-01-12").cohorts is None
    assert rows_of(cohorts_of(spark, paths)) == rows_of(build_retention(events, 1))


def test_another_threshold_rebuilds_all_cohorts(spark, tmp_dir):
    events, paths = events_of(spark, 14, 150), paths_in(tmp_dir)
    build_and_write(spark, events, paths, 1)
    for minimum in (2, 1):
        assert build_and_write(spark, events, paths, minimum, "2024-01-10", "2024-01-11").cohorts is None
        assert rows_of(cohorts_of(spark, paths)) == rows_of(build_retention(events, minimum))
    assert build_and_write(spark, events, paths, 1, "2024-01-10", "2024-01-11").cohorts == set()
