import dataclasses
import datetime as dt
import os

import pytest
from helpers import curated
from pyspark.sql import functions as F

from playpulse.config import JobConfig, shared_dir
from playpulse.operators.quality import QualityGateError
from playpulse.operators.retention import build_retention, player_activity_days
from playpulse.operators.serving import (
    read_serving,
    replace_date_range,
    serving_engagement,
    split_null_keys,
    upsert_by_key,
)
from playpulse.operators.sessions import build_sessions
from playpulse.plans.build import build_and_write, build_tables
from playpulse.plans.daily import run_daily
from playpulse.sources.serving import read_serving_table
from playpulse.sources.tables import (
    compact,
    create_table_sql,
    file_count,
    read_table_path,
    write_partitioned,
    write_table,
)


def _sessions(spark, days):
    return build_sessions(curated(spark, [dict(session_id=f"s{d}", event_time=f"2024-01-0{d} 10:00:00") for d in days]))


def test_dynamic_overwrite_keeps_absent_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sessions")
    write_table(_sessions(spark, [1, 2, 3]), "player_sessions", path, "static")
    write_table(_sessions(spark, [3, 4]), "player_sessions", path, "dynamic")
    days = sorted(r.event_date.day for r in spark.read.parquet(path).collect())
    assert days == [1, 2, 3, 4]
    write_table(_sessions(spark, [4]), "player_sessions", path, "static")
    assert [r.event_date.day for r in spark.read.parquet(path).collect()] == [4]


def test_empty_table_reads_with_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    write_table(_sessions(spark, [1]).limit(0), "player_sessions", path, "static")
    assert read_table_path(spark, path, "player_sessions").count() == 0
    assert "PARTITIONED BY (event_date)" in create_table_sql("player_sessions", path)


def test_compaction_keeps_rows(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "small"), os.path.join(tmp_dir, "big")
    df = curated(spark, [dict(event_time=f"2024-01-0{1 + i % 3} 10:00:{i % 60:02d}") for i in range(90)])
    write_partitioned(df, src, "event_date", "static", max_records_per_file=5)
    before = file_count(spark, src)
    out = compact(spark, src, dst, "event_date", table="game_events")
    assert before >= 18 and file_count(spark, dst) < before
    cols = sorted(out.columns)
    assert sorted(out.select(cols).collect()) == sorted(spark.read.parquet(src).select(cols).collect())
    with pytest.raises(ValueError):
        compact(spark, src, src, "event_date")


def test_compact_partitions_in_place(spark, tmp_dir):
    from playpulse.sources.tables import compact_partitions

    path = os.path.join(tmp_dir, "events")
    df = curated(spark, [dict(event_time=f"2024-01-0{1 + i % 3} 10:00:{i % 60:02d}") for i in range(60)])
    write_partitioned(df, path, "event_date", "static", max_records_per_file=2)
    day = os.path.join(path, "event_date=2024-01-02")
    other = os.path.join(path, "event_date=2024-01-03")
    before_other = sorted(os.listdir(other))
    n_before = len([f for f in os.listdir(day) if f.endswith(".parquet")])
    compact_partitions(spark, path, "event_date", ["2024-01-02"], table="game_events")
    n_after = len([f for f in os.listdir(day) if f.endswith(".parquet")])
    assert n_after < n_before
    assert sorted(os.listdir(other)) == before_other  # untouched
    cols = sorted(df.columns)
    assert sorted(spark.read.parquet(path).select(cols).collect()) == sorted(df.select(cols).collect())


def _three_days(spark, path):
    df = curated(spark, [dict(event_time=f"2024-01-0{1 + i % 3} 10:00:{i % 60:02d}") for i in range(60)])
    write_partitioned(df, path, "event_date", "static", max_records_per_file=2)
    cols = sorted(df.columns)
    return lambda: sorted(spark.read.parquet(path).select(cols).collect()) == sorted(df.select(cols).collect())


def test_compact_partitions_writes_rows_once(spark, tmp_dir, monkeypatch):
    from playpulse.sources import tables

    path = os.path.join(tmp_dir, "events")
    whole, writes = _three_days(spark, path), []
    write = tables.write_partitioned
    monkeypatch.setattr(tables, "write_partitioned", lambda df, to, *a: (writes.append(to), write(df, to, *a)))
    monkeypatch.setattr(tables, "scratch", lambda spark: pytest.fail("rows are copied before they are compacted"))
    cached = spark.read.parquet(path).cache()
    assert cached.count() == 60
    tables.compact_partitions(spark, path, "event_date", ["2024-01-01", "2024-01-02", "2024-02-01"], table="game_events")
    assert len(writes) == 1 and writes[0] != path
    assert whole() and cached.count() == 60
    cached.unpersist()
    assert sorted(n for n in os.listdir(path) if n[0] not in "._") == [f"event_date=2024-01-0{d}" for d in (1, 2, 3)]
    assert not [n for n in os.listdir(path) if n.startswith("_compact")]
    tables.compact_partitions(spark, path, "event_date", ["2024-02-01"])  # no rows
    assert whole()


def test_compact_partitions_moves_back_what_it_cannot_replace(spark, tmp_dir, monkeypatch):
    from playpulse.sources import tables

    path = os.path.join(tmp_dir, "events")
    whole = _three_days(spark, path)
    move = tables.move

    def failing(spark, at, to):
        if "/new/event_date=2024-01-02" in at:
            raise OSError("no space")
        move(spark, at, to)

    monkeypatch.setattr(tables, "move", failing)
    with pytest.raises(OSError, match="no space"):
        tables.compact_partitions(spark, path, "event_date", ["2024-01-01", "2024-01-02", "2024-01-03"], table="game_events")
    assert whole()


def test_a_failed_write_leaves_the_partitions(spark, tmp_dir, monkeypatch):
    from playpulse.sources import tables

    path = os.path.join(tmp_dir, "events")
    whole = _three_days(spark, path)
    with pytest.raises(Exception, match="nowhere"):
        tables.compact_partitions(spark, path, "event_date", ["2024-01-02"], sort_within=["nowhere"])
    assert whole() and not [n for n in os.listdir(path) if n.startswith("_compact")]


def test_many_small_files_have_no_files_beside_them(spark, tmp_dir, monkeypatch):
    """Each file of the queries' small-file tables is one file; file sizes stay as asked for."""
    from playpulse import registry

    rows = curated(spark, [dict(event_time=f"2024-01-0{1 + i % 2} 10:00:{i % 60:02d}") for i in range(300)])
    monkeypatch.setattr(registry, "_cur", lambda spark, sf_dir: rows)
    made = []
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: made.append(os.path.join(tmp_dir, name)) or made[-1])
    out = registry.SPARK["compact_table"](spark, tmp_dir)
    assert sorted(out.collect()) == sorted(rows.select(*out.columns).collect())
    for day in (1, 2):
        files = os.listdir(os.path.join(made[0], f"event_date=2024-01-0{day}"))
        assert len(files) == 3 and all(f.startswith("part-") and f.endswith(".parquet") for f in files)
    assert {r["count"] for r in spark.read.parquet(made[0]).groupBy(F.input_file_name()).count().collect()} == {50}


def _engagement_rows(spark, rows):
    schema = ("game_id string, event_date date, platform string, build string, country_code string, "
              "dau long, sessions long, avg_session_seconds double, p95_session_seconds long, "
              "crash_free_session_rate double, revenue_usd double")
    return serving_engagement(spark.createDataFrame(rows, schema))


def test_upsert_replace_add_and_null_keys(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    existing = _engagement_rows(spark, [("g", d1, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0),
                                        ("g", d2, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0)])
    updates = _engagement_rows(spark, [("g", d2, "ios", "1", "US", 30, 2, 2.0, 2, 0.5, 9.0),
                                       ("g", d2, "ios", "1", "CA", 25, 2, 2.0, 2, 0.5, 1.0),
                                       ("g", d2, None, "1", "US", 99, 2, 2.0, 2, 0.5, 1.0)])
    table = "daily_engagement_by_game_day"
    out = {(r.activity_date, r.country_code): r.dau for r in upsert_by_key(existing, updates, table).collect()}
    assert out == {(d1, "US"): 20, (d2, "US"): 30, (d2, "CA"): 25}
    _, bad = split_null_keys(updates, table)
    assert bad.count() == 1
    replaced = replace_date_range(existing, updates.filter(F.col("country_code") == "CA"), table, "2024-01-02", "2024-01-02")
    assert {(r.activity_date, r.country_code) for r in replaced.collect()} == {(d1, "US"), (d2, "CA")}


def test_serving_read_order(spark):
    rows = []
    for day in (1, 2, 3):
        for plat in ("ios", "android"):
            rows.append(("g", dt.date(2024, 1, day), plat, "1", "US", 20, 1, 1.0, 1, 1.0, 0.0))
    rows.append(("g", dt.date(2024, 2, 1), "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0))
    rows.append(("h", dt.date(2024, 1, 1), "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0))
    got = read_serving(_engagement_rows(spark, rows), "daily_engagement_by_game_day", "g", "2024-01").collect()
    assert [(r.activity_date.day, r.platform) for r in got] == [
        (3, "android"), (3, "ios"), (2, "android"), (2, "ios"), (1, "android"), (1, "ios")]


def test_daily_run_gate_stops_build(spark, tmp_dir):
    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    ev = curated(spark, [dict(event_time="2024-01-02 10:00:00"), dict(event_time="2024-01-02 11:00:00")])
    write_table(ev, "game_events", cfg.table_path(cfg.raw_table), "static")
    res = run_daily(spark, cfg, "2024-01-02", version="v1")
    eng = spark.read.parquet(res.serving["daily_engagement_by_game_day"]).collect()
    assert len(eng) == 1 and eng[0].dau == 1
    assert set(res.compacted) == {"game_events", "player_days", "player_sessions", "daily_engagement", "level_progression", "economy_flows"}
    with pytest.raises(QualityGateError):
        run_daily(spark, cfg, "2024-01-05", version="v2", previous_version="v1")
    assert not os.path.exists(cfg.serving_path("daily_engagement_by_game_day") + "/v2")


def test_job_entry_points(spark, tmp_dir, monkeypatch, capsys):
    from playpulse.plans import build as build_job
    from playpulse.plans import curate as curate_job
    from playpulse.plans import gate as gate_job
    from playpulse.plans import maintain as maintain_job
    from playpulse.plans import publish as publish_job

    monkeypatch.setenv("WAREHOUSE_PATH", tmp_dir)
    monkeypatch.setenv("MINIMUM_PRIVACY_GROUP", "1")
    cfg = JobConfig.from_env()
    ev = curated(spark, [dict(event_time="2024-01-02 10:00:00", category="business", amount=100),
                         dict(event_time="2024-01-03 10:00:00")])
    write_table(ev, "game_events", cfg.table_path(cfg.raw_table), "static")
    assert curate_job.main(["--start=2024-01-01", "--end=2024-01-03"]) == 0
    assert gate_job.main(["--run-date=2024-01-02"]) == 0
    assert "QUALITY_CHECK_PASSED: 1 events validated for 2024-01-02" in capsys.readouterr().out
    assert gate_job.main(["--run-date=2024-02-01"]) == 1
    assert "QUALITY_CHECK_FAILED: No events found for 2024-02-01" in capsys.readouterr().err
    assert build_job.main([]) == 0
    assert spark.read.parquet(cfg.table_path("daily_engagement")).count() == 2
    assert publish_job.main(["--version=v1"]) == 0
    assert spark.read.parquet(cfg.serving_path("daily_engagement_by_game_day") + "/v1").count() == 2
    assert maintain_job.main(["--dates=2024-01-02"]) == 0
    assert spark.read.parquet(cfg.table_path(cfg.curated_table)).count() == 2


def test_compaction_clusters_categories(spark, tmp_dir):
    import pyarrow.parquet as pq

    from playpulse.sources.tables import compact_partitions

    path = os.path.join(tmp_dir, "events")
    cats = ["user", "business", "progression", "resource"]
    df = curated(spark, [dict(event_time=f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}", category=cats[i % 4]) for i in range(400)])
    write_partitioned(df, path, "event_date", "static")
    compact_partitions(spark, path, "event_date", ["2024-01-01"], table="game_events", max_records_per_file=100)
    day = os.path.join(path, "event_date=2024-01-01")
    ranges = []
    for f in sorted(os.listdir(day)):
        if f.endswith(".parquet"):
            t = pq.read_table(os.path.join(day, f), columns=["category"]).column("category").to_pylist()
            ranges.append((min(t), max(t)))
    assert all(lo == hi for lo, hi in ranges)  # one category per file after clustering
    assert spark.read.parquet(path).count() == 400


def test_publish_partitions_in_place(spark, tmp_dir):
    from playpulse.sources.serving import publish_partitions

    table = "daily_engagement_by_game_day"
    path = os.path.join(tmp_dir, "serving")
    d1, d2, f1 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 1)
    first = _engagement_rows(spark, [("g", d1, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0),
                                     ("g", d2, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0),
                                     ("g", f1, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0)])
    publish_partitions(spark, first, table, path)
    feb = os.path.join(path, "activity_month=2024-02")
    feb_files = sorted(os.listdir(feb))
    update = _engagement_rows(spark, [("g", d2, "ios", "1", "US", 30, 2, 2.0, 2, 0.5, 9.0),
                                      ("g", d2, "ios", "1", "CA", 25, 2, 2.0, 2, 0.5, 1.0),
                                      ("g", d2, None, "1", "US", 99, 2, 2.0, 2, 0.5, 1.0)])
    out = publish_partitions(spark, update, table, path)
    got = {(r.activity_date, r.country_code): r.dau for r in out.collect()}
    assert got == {(d1, "US"): 20, (d2, "US"): 30, (d2, "CA"): 25, (f1, "US"): 20}
    assert sorted(os.listdir(feb)) == feb_files  # an untouched month is not rewritten


def test_daily_run_in_place_twice(spark, tmp_dir):
    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    ev = curated(spark, [dict(event_time="2024-01-02 10:00:00"), dict(event_time="2024-01-03 11:00:00")])
    write_table(ev, "game_events", cfg.table_path(cfg.raw_table), "static")
    run_daily(spark, cfg, "2024-01-02")
    res = run_daily(spark, cfg, "2024-01-03")
    days = sorted(r.activity_date.day for r in spark.read.parquet(res.serving["daily_engagement_by_game_day"]).collect())
    assert days == [2, 3]


def _days(spark, cfg, name):
    return sorted(tuple(r) for r in read_table_path(spark, cfg.table_path(name), name).collect())


def test_late_rows_reach_every_day_grained_table(spark, tmp_dir):
    early = [dict(event_time=f"2024-01-02 {h:02d}:00:00", category=c, amount=100, progression_01="L1", progression_status="start",
                  virtual_currency="gold", item_type="x", flow_type="source") for h in (1, 2) for c in ("business", "progression", "resource")]
    late = [{**e, "event_time": e["event_time"].replace(" 0", " 2")} for e in early]
    last = [{**e, "event_time": e["event_time"].replace("-02 ", "-03 ")} for e in early]
    tables = ("player_sessions", "daily_engagement", "level_progression", "economy_flows", "cohort_retention", "player_days")
    runs, whole = (JobConfig(warehouse=os.path.join(tmp_dir, d), player_salt="s", minimum_privacy_group=1) for d in ("a", "b"))
    write_table(curated(spark, early), "game_events", runs.table_path(runs.raw_table), "append")
    run_daily(spark, runs, "2024-01-02")
    write_table(curated(spark, [{**e, "event_uuid": f"l{i}"} for i, e in enumerate(late + last)]), "game_events", runs.table_path(runs.raw_table), "append")
    run_daily(spark, runs, "2024-01-03")
    write_table(read_table_path(spark, runs.table_path(runs.raw_table), "game_events"), "game_events", whole.table_path(whole.curated_table), "static")
    build_and_write(spark, read_table_path(spark, whole.table_path(whole.curated_table), "game_events"), {t: whole.table_path(t) for t in tables}, 1)
    for t in tables:
        assert _days(spark, runs, t) == _days(spark, whole, t) != [], t


def test_suppressed_groups_leave_all_tables(spark, tmp_dir):
    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    ev = curated(spark, [dict(event_time="2024-01-02 10:00:00"), dict(event_time="2024-01-03 10:00:00")])
    write_table(ev, "game_events", cfg.table_path(cfg.raw_table), "static")
    run_daily(spark, cfg, "2024-01-02")
    res = run_daily(spark, cfg, "2024-01-03")
    serving = res.serving["daily_engagement_by_game_day"]
    assert spark.read.parquet(serving).count() == 2
    res = run_daily(spark, dataclasses.replace(cfg, minimum_privacy_group=5), "2024-01-03")
    for table, path in res.serving.items():
        assert read_serving_table(spark, path, table).count() == 0
    assert _days(spark, cfg, "daily_engagement") == [] and _days(spark, cfg, "cohort_retention") == []
    assert len(_days(spark, cfg, "player_sessions")) == 2


def test_rows_with_null_keys_reach_no_store(spark, tmp_dir, monkeypatch):
    from playpulse.sources import serving as S

    table, day = "daily_engagement_by_game_day", dt.date(2024, 1, 2)
    rows = _engagement_rows(spark, [("g", day, "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0), ("g", day, None, "1", "US", 9, 1, 1.0, 1, 1.0, 0.0)])
    sent = []
    monkeypatch.setattr(S, "write_keyed_store", lambda df, *a: sent.append((df.count(), *a)))
    cfg = JobConfig.from_env({"SERVING_FORMAT": "store", "SERVING_OPTIONS": '{"keyspace": "k"}', "WAREHOUSE_PATH": tmp_dir})
    S.publish(spark, rows, table, cfg)
    assert sent == [(1, table, "store", {"keyspace": "k"})]
    for kwargs in ({}, {"new_path": tmp_dir + "/v1"}):
        out = S.publish(spark, rows, table, JobConfig(warehouse=tmp_dir), **kwargs)
        assert out.count() == 1


def test_a_missing_previous_version_is_an_error(spark, tmp_dir):
    from playpulse.sources.serving import publish_parquet

    rows = _engagement_rows(spark, [("g", dt.date(2024, 1, 2), "ios", "1", "US", 20, 1, 1.0, 1, 1.0, 0.0)])
    with pytest.raises(FileNotFoundError):
        publish_parquet(spark, rows, "daily_engagement_by_game_day", tmp_dir + "/v0", tmp_dir + "/v1")
    assert not os.path.exists(tmp_dir + "/v1")


def test_a_streamed_folder_is_not_compacted(spark, tmp_dir):
    from playpulse.sources.tables import compact_partitions

    path = os.path.join(tmp_dir, "landing")
    write_table(curated(spark, [dict(event_time="2024-01-02 10:00:00")]), "game_events", path, "static")
    os.makedirs(path + "/_spark_metadata")
    with pytest.raises(ValueError, match="stream"):
        compact_partitions(spark, path, "event_date", ["2024-01-02"], table="game_events")


def test_rows_that_land_during_a_run_are_kept(spark, tmp_dir, monkeypatch):
    """They wait in the landing table, which no job rewrites, for the next run."""
    from playpulse.plans import daily

    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    landing = cfg.table_path(cfg.raw_table)
    write_table(curated(spark, [dict(event_time="2024-01-02 10:00:00")]), "game_events", landing, "static")
    late = curated(spark, [dict(event_uuid="late", event_time="2024-01-02 11:00:00")])
    build = daily.build_and_write
    monkeypatch.setattr(daily, "build_and_write", lambda *a, **k: (write_table(late, "game_events", landing, "append"), build(*a, **k))[1])
    run_daily(spark, cfg, "2024-01-02")
    monkeypatch.undo()
    assert read_table_path(spark, landing, "game_events").count() == 2
    run_daily(spark, cfg, "2024-01-02")
    assert read_table_path(spark, cfg.table_path(cfg.curated_table), "game_events").count() == 2


def test_a_run_leaves_no_scratch(spark, tmp_dir):
    before = set(os.listdir(shared_dir(spark)))
    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    write_table(curated(spark, [dict(event_time="2024-01-02 10:00:00")]), "game_events", cfg.table_path(cfg.raw_table), "static")
    run_daily(spark, cfg, "2024-01-02")
    assert set(os.listdir(shared_dir(spark))) == before


def test_retention_reads_stored_player_days(spark, tmp_dir):
    """A daily build's cohorts come from the player days; events of other days are not read."""
    cfg = JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1)
    ev = curated(spark, [dict(event_time="2024-01-01 10:00:00"), dict(event_time="2024-01-02 10:00:00")])
    path = cfg.table_path("player_days")
    write_table(player_activity_days(ev), "player_days", path, "static")
    days = read_table_path(spark, path, "player_days")
    tables = build_tables(ev, 1, "2024-01-02", "2024-01-02", player_days=days)
    plan = tables["cohort_retention"]._jdf.queryExecution().executedPlan().toString()
    assert "player_days" in plan and plan.count("Exchange hashpartitioning") == 2
    full = build_retention(ev, 1)._jdf.queryExecution().executedPlan().toString()
    assert full.count("Exchange hashpartitioning") == 3
    assert sorted(map(tuple, tables["cohort_retention"].collect())) == sorted(map(tuple, build_retention(ev, 1).collect()))


def test_write_layout(spark, tmp_dir):
    """Rebalanced writes aim at the session's advisory size; serving files are sorted by key."""
    import pyarrow.parquet as pq

    from playpulse.config import WRITE_BYTES
    from playpulse.sources.serving import publish_partitions

    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == WRITE_BYTES
    path = os.path.join(tmp_dir, "events")
    ev = curated(spark, [dict(event_uuid=f"e{i}", event_time=f"2024-01-01 10:00:{i % 60:02d}") for i in range(300)])
    write_table(ev.repartition(20), "game_events", path, "static")
    assert file_count(spark, path) == 1  # twenty small partitions, one file
    table = "daily_engagement_by_game_day"
    rows = [(g, dt.date(2024, 1, d), p, "1", "US", 20, 1, 1.0, 1, 1.0, 0.0) for g in "cab" for d in (3, 1, 2) for p in ("ios", "android")]
    serving = os.path.join(tmp_dir, "serving")
    publish_partitions(spark, _engagement_rows(spark, rows), table, serving)
    month = os.path.join(serving, "activity_month=2024-01")
    for f in os.listdir(month):
        if f.endswith(".parquet"):
            t = pq.read_table(os.path.join(month, f)).select(["game_id", "activity_date", "platform"]).to_pylist()
            assert t == sorted(t, key=lambda r: (r["game_id"], -r["activity_date"].toordinal(), r["platform"]))
