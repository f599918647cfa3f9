"""Tables addressed by name: partitions, buckets, statistics, and the jobs on names alone."""

import datetime as dt
import os
import uuid

import pytest
from helpers import curated
from test_plans import plan

from playpulse.config import CatalogTable, JobConfig
from playpulse.operators.engagement import build_daily_engagement
from playpulse.operators.retention import (
    activity_of_days,
    flags_of_days,
    player_activity_days,
    retention_of_activity,
)
from playpulse.operators.sessions import build_sessions, session_facts
from playpulse.plans import build as build_job
from playpulse.plans import curate as curate_job
from playpulse.plans import gate as gate_job
from playpulse.plans import maintain as maintain_job
from playpulse.plans import publish as publish_job
from playpulse.plans.build import build_and_write, curated_at, tables_at
from playpulse.plans.curate import curate_days
from playpulse.plans.daily import run_daily
from playpulse.sources.compaction import compact_small_files
from playpulse.sources.tables import (
    buckets_of,
    drop_partitions,
    ensure_table,
    partitions_of,
    read_table_path,
    replace_days,
    write_table,
)


def config_of(tmp_dir, **more):
    return JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1, catalog=f"t{uuid.uuid4().hex[:8]}_", buckets=4, **more)


def landed(spark, cfg, events, mode="append"):
    at = cfg.table_at(cfg.raw_table)
    ensure_table(spark, at, "game_events", cfg.table_path(cfg.raw_table), buckets=0)
    write_table(events, "game_events", at, mode)
    return at


def some_events(spark, days=(1, 2, 3), players=20):
    return curated(spark, [
        dict(event_uuid=f"{d}-{p}", event_time=f"2024-01-{d:02d} 1{p % 10}:00:00", player_key=f"p{p}", session_id=f"s{p}", game_id="hot" if p % 3 else f"g{p}",
             category=["business", "progression", "resource"][p % 3], amount=p, progression_01="L1", progression_status="start",
             virtual_currency="gold", item_type="x", flow_type="source")
        for d in days for p in range(players)
    ])


def test_a_write_follows_the_catalog(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    at = curated_at(spark, cfg)
    assert isinstance(at, CatalogTable) and buckets_of(spark, at) == (["player_key"], 4)
    events = some_events(spark)
    write_table(events, "game_events", at, "static")
    assert partitions_of(spark, at) == {dt.date(2024, 1, d) for d in (1, 2, 3)}
    columns = events.columns
    assert sorted(map(tuple, read_table_path(spark, at, "game_events").select(columns).collect())) == sorted(map(tuple, events.collect()))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # a day's write must not empty the table all the same
    write_table(some_events(spark, (2,), 5), "game_events", at)
    assert {r[0].day: r[1] for r in spark.table(str(at)).groupBy("event_date").count().collect()} == {1: 20, 2: 5, 3: 20}
    stats = [r[1] for r in spark.sql(f"DESCRIBE EXTENDED {at} PARTITION (event_date = '2024-01-02')").collect() if r[0] == "Partition Statistics"]
    assert stats and stats[0].endswith("5 rows")
    write_table(some_events(spark, (4,)), "game_events", at, "static")
    assert partitions_of(spark, at) == {dt.date(2024, 1, 4)} and spark.table(str(at)).count() == 20
    write_table(some_events(spark, (4,)), "game_events", at, "append")
    assert spark.table(str(at)).count() == 40
    drop_partitions(spark, at, "event_date", [dt.date(2024, 1, 4), dt.date(2030, 1, 1)])
    assert spark.table(str(at)).count() == 0 and not os.path.exists(cfg.table_path(cfg.curated_table) + "/event_date=2024-01-04")


def test_a_table_over_an_existing_folder_finds_its_days(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    path = cfg.table_path(cfg.raw_table)
    write_table(some_events(spark), "game_events", path, "static")
    at = cfg.table_at(cfg.raw_table)
    ensure_table(spark, at, "game_events", path, buckets=0)
    ensure_table(spark, at, "game_events", path, buckets=0)
    assert len(partitions_of(spark, at)) == 3 and read_table_path(spark, at, "game_events").count() == 60


def test_buckets_hold_one_file_a_day(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    at = curated_at(spark, cfg)
    write_table(some_events(spark, players=200).repartition(8), "game_events", at, "static")
    day = cfg.table_path(cfg.curated_table) + "/event_date=2024-01-02"
    buckets = [f.split("_")[-1].split(".")[0] for f in os.listdir(day) if f.endswith(".parquet")]
    assert sorted(buckets) == ["00000", "00001", "00002", "00003"]


def test_player_aggregates_need_no_shuffle(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    at, tables = curated_at(spark, cfg), tables_at(spark, cfg)
    events = some_events(spark, players=60)
    write_table(events, "game_events", at, "static")
    stored = read_table_path(spark, at, "game_events")
    days = player_activity_days(stored, clustered=True)
    for df in (build_sessions(stored), session_facts(stored), days, flags_of_days(days)):
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    write_table(days, "player_days", tables["player_days"], "static")
    stored_days = read_table_path(spark, tables["player_days"], "player_days")
    for df in (flags_of_days(stored_days), activity_of_days(stored_days)):
        assert "Exchange" not in plan(df)
    write_table(activity_of_days(stored_days), "player_activity", tables["player_activity"], "static")
    cohorts = retention_of_activity(read_table_path(spark, tables["player_activity"], "player_activity"), 1)
    assert plan(cohorts).count("Exchange hashpartitioning") == 1  # the one by cohort
    assert "Exchange" in plan(build_sessions(events))
    one_day = plan(build_sessions(stored.where("event_date = DATE '2024-01-02'")))
    assert "Exchange" not in one_day and "PartitionFilters: [isnotnull(event_date" in one_day
    assert sorted(map(tuple, build_sessions(stored).collect())) == sorted(map(tuple, build_sessions(events).collect()))


def test_a_daily_run_on_names_equals_one_on_paths(spark, tmp_dir):
    named, plain = config_of(tmp_dir + "/a"), JobConfig(warehouse=tmp_dir + "/b", player_salt="s", minimum_privacy_group=1)
    landed(spark, named, some_events(spark))
    write_table(some_events(spark), "game_events", plain.table_path(plain.raw_table), "static")
    for day in ("2024-01-02", "2024-01-03"):
        a, b = run_daily(spark, named, day), run_daily(spark, plain, day)
    assert all(isinstance(at, CatalogTable) for at in a.tables.values()) and a.events == b.events == 20
    for t in b.tables:
        got = read_table_path(spark, a.tables[t], t)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, read_table_path(spark, b.tables[t], t).select(got.columns).collect())) != [], t
    assert a.left_out == b.left_out and a.serving.keys() == b.serving.keys()


def test_jobs_on_names(spark, tmp_dir, monkeypatch, capsys):
    cfg = config_of(tmp_dir)
    for key, value in {"WAREHOUSE_PATH": tmp_dir, "MINIMUM_PRIVACY_GROUP": "1", "TABLE_CATALOG": cfg.catalog, "TABLE_BUCKETS": "4", "PLAYER_HASH_SALT": "s"}.items():
        monkeypatch.setenv(key, value)
    assert JobConfig.from_env() == cfg
    landed(spark, cfg, some_events(spark))
    assert curate_job.main(["--start=2024-01-01", "--end=2024-01-03"]) == 0
    assert gate_job.main(["--run-date=2024-01-02"]) == 0 and gate_job.main(["--run-date=2024-02-02"]) == 1
    assert build_job.main([]) == 0
    sessions = tables_at(spark, cfg)["player_sessions"]
    assert spark.table(str(sessions)).count() == 60
    assert build_job.main(["--start=2024-01-02", "--end=2024-01-02"]) == 0
    assert spark.table(str(sessions)).count() == 60
    assert publish_job.main([]) == 0 and publish_job.main(["--start=2024-01-02", "--end=2024-01-09"]) == 0
    serving = spark.read.parquet(cfg.serving_path("daily_engagement_by_game_day"))
    assert serving.count() == build_daily_engagement(session_facts(some_events(spark)), minimum_group_size=1).count()
    assert maintain_job.main(["--dates=2024-01-02"]) == 0
    assert "0 small files of 0 days merged" in capsys.readouterr().out


def test_bucketed_days_are_compacted(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    at = curated_at(spark, cfg)
    for _ in range(3):
        write_table(some_events(spark), "game_events", at, "append")
    before = sorted(map(repr, spark.table(str(at)).collect()))
    day, other = (f"{cfg.table_path(cfg.curated_table)}/event_date=2024-01-0{d}" for d in (2, 3))
    kept = sorted(os.listdir(other))
    assert compact_small_files(spark, at, "game_events", [dt.date(2024, 1, 2)]) == {dt.date(2024, 1, 2): 12}
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) == 4 and sorted(os.listdir(other)) == kept
    assert sorted(map(repr, spark.table(str(at)).collect())) == before
    assert compact_small_files(spark, at, "game_events", [dt.date(2024, 1, 2)]) == {}


def test_a_row_of_an_unwanted_day_fails_the_write(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    at = curated_at(spark, cfg)
    write_table(some_events(spark), "game_events", at, "static")
    for target in (at, tmp_dir + "/plain"):
        with pytest.raises(Exception, match="unwanted partition 2024-01-03"):
            replace_days(some_events(spark, players=2), "game_events", target, "2024-01-01", "2024-01-02")
    assert spark.table(str(at)).count() == 60
    none = some_events(spark).limit(0)
    assert replace_days(none, "game_events", at, "2024-01-01", "2024-01-02") == set()
    assert partitions_of(spark, at) == {dt.date(2024, 1, 3)}


def test_an_expired_landing_day_stays_curated_and_built(spark, tmp_dir):
    for cfg in (config_of(tmp_dir + "/a"), JobConfig(warehouse=tmp_dir + "/b", player_salt="s", minimum_privacy_group=1)):
        raw = cfg.table_at(cfg.raw_table)
        ensure_table(spark, raw, "game_events", cfg.table_path(cfg.raw_table), buckets=0)
        write_table(some_events(spark, (1, 2)), "game_events", raw, "append")
        result = run_daily(spark, cfg, "2024-01-02")
        rows = {t: read_table_path(spark, p, t).count() for t, p in result.tables.items()}
        serving = {t: spark.read.parquet(p).count() for t, p in result.serving.items()}
        drop_partitions(spark, raw, "event_date", [dt.date(2024, 1, 1)])
        result = run_daily(spark, cfg, "2024-01-02")
        assert read_table_path(spark, curated_at(spark, cfg), "game_events").count() == 40
        assert {t: read_table_path(spark, p, t).count() for t, p in result.tables.items()} == rows
        drop_partitions(spark, curated_at(spark, cfg), "event_date", [dt.date(2024, 1, 1)])  # gone there as well
        curate_days(spark, cfg, "2024-01-01", "2024-01-02")
        result = run_daily(spark, cfg, "2024-01-02")
        assert {t: read_table_path(spark, p, t).count() for t, p in result.tables.items()} == rows
        assert {t: spark.read.parquet(p).count() for t, p in result.serving.items()} == serving
        build_and_write(spark, read_table_path(spark, curated_at(spark, cfg), "game_events"), result.tables, 1, "2024-01-01", "2024-01-01")
        assert {t: read_table_path(spark, p, t).count() for t, p in result.tables.items()} == rows
