"""Ids that come again days later, and what micro-batches drop."""

import json
import os

import pytest
from helpers import curated
from test_catalog import config_of, landed
from test_plans import plan

from playpulse.config import JobConfig
from playpulse.operators.replays import id_hashes, replays
from playpulse.plans import replays as replay_job
from playpulse.plans.curate import curate_days
from playpulse.plans.daily import run_daily
from playpulse.plans.replays import index_at, index_days, replayed_on
from playpulse.sources.tables import read_table_path, write_table
from playpulse.streaming.ingest import ingest, ingest_writer, read_json_stream
from playpulse.streaming.metrics import recorded


def events_of(spark, days):
    """{day: ids}"""
    return curated(spark, [dict(event_uuid=i, event_time=f"2024-01-{d:02d} 10:00:00", player_key=f"p{i}") for d, ids in days.items() for i in ids])


DAYS = {1: "abcd", 2: "ef", 3: "agg", 5: "aaeh"}


@pytest.mark.parametrize("named", [False, True])
def test_replays_across_days(spark, tmp_dir, named):
    cfg = config_of(tmp_dir) if named else JobConfig(warehouse=tmp_dir, player_salt="s")
    landed(spark, cfg, events_of(spark, DAYS))
    curate_days(spark, cfg, "2024-01-01", "2024-01-31")
    for d in DAYS:  # day by day, as the job does
        index_days(spark, cfg, f"2024-01-{d:02d}", f"2024-01-{d:02d}")
    got = {d: tuple(replayed_on(spark, cfg, f"2024-01-{d:02d}").first())[1:] for d in (1, 2, 3, 4, 5)}
    assert got == {1: (0, 0), 2: (0, 0), 3: (1, 1), 4: (0, 0), 5: (2, 3)}
    from dataclasses import replace

    assert tuple(replayed_on(spark, replace(cfg, replay_days=2), "2024-01-05").first())[1:] == (1, 2)  # only from the third on


def test_the_index_is_read_without_a_shuffle_and_events_are_not(spark, tmp_dir):
    cfg = config_of(tmp_dir)
    landed(spark, cfg, events_of(spark, DAYS))
    curate_days(spark, cfg, "2024-01-01", "2024-01-31")
    index_days(spark, cfg, "2024-01-01", "2024-01-31")
    text = plan(replayed_on(spark, cfg, "2024-01-05"))
    assert "ShuffledHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "event_ids" in text and "game_events" not in text and "event_uuid" not in text
    ids = read_table_path(spark, index_at(spark, cfg), "event_ids")
    assert ids.count() == 4 + 2 + 2 + 3


def test_null_ids_are_left_out(spark):
    events = curated(spark, [dict(event_uuid=None, event_time="2024-01-01 10:00:00"), dict(event_uuid="x", event_time="2024-01-01 10:00:00")])
    hashes = id_hashes(events)
    assert hashes.count() == 1
    assert tuple(replays(hashes, hashes.where("false")).first()) == (0, 0)


def test_the_daily_run_counts_replays(spark, tmp_dir, monkeypatch, capsys):
    from dataclasses import replace

    cfg = replace(JobConfig(warehouse=tmp_dir, player_salt="s", minimum_privacy_group=1), replay_days=0)
    write_table(events_of(spark, {1: "abcd", 2: "ae"}), "game_events", cfg.table_path(cfg.raw_table), "static")
    assert [run_daily(spark, cfg, d).replayed for d in ("2024-01-01", "2024-01-02")] == [0, 1]
    monkeypatch.setenv("WAREHOUSE_PATH", tmp_dir)
    monkeypatch.setenv("REPLAY_DAYS", "0")
    assert JobConfig.from_env().replay_days == 0
    assert replay_job.main(["--run-date=2024-01-02"]) == 0
    assert "1 event ids of earlier days, 1 rows" in capsys.readouterr().out


def test_dropped_rows_are_kept_per_batch(spark, tmp_dir):
    src, out, ck, metrics = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck", "metrics"))
    os.makedirs(src)
    t = lambda day, i: dict(event_uuid=f"e{day}-{i}", event_time=f"2024-01-{day:02d}T10:00:00Z", game_id="g", user_id="u", session_id="s", category="user")
    parts = [[t(10, i) for i in range(3)], [t(20, i) for i in range(4)], [t(1, i) for i in range(5)] + [t(20, 9)]]
    for n, part in enumerate(parts):
        with open(os.path.join(src, f"{n}.json"), "w") as f:
            f.write("\n".join(map(json.dumps, part)) + "\n")
        query = ingest_writer(ingest(read_json_stream(spark, src, None), "salt"), ck, available_now=True).start(out)
        recorded(spark, query, metrics)
    rows = spark.read.parquet(metrics).orderBy("batch_id").collect()
    assert [(r.input_rows, r.dropped_rows) for r in rows] == [(3, 0), (4, 0), (6, 5)]
    assert len({r.query_id for r in rows}) == 1 and all(r.watermark for r in rows)
    assert spark.read.parquet(out).count() == 8


def test_metrics_survive_a_failed_query(spark, tmp_dir):
    class Failing:
        recentProgress = [{"id": "q", "batchId": 0, "numInputRows": 2, "stateOperators": [{"numRowsDroppedByWatermark": 1, "numRowsTotal": 1}], "eventTime": {}}]

        def awaitTermination(self, _):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        recorded(spark, Failing(), tmp_dir + "/m")
    assert [(r.batch_id, r.dropped_rows) for r in spark.read.parquet(tmp_dir + "/m").collect()] == [(0, 1)]
