import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from playpulse.operators.decode import decode_events
from playpulse.schema import CURATED_EVENT_COLUMNS
from playpulse.streaming.ingest import ingest, ingest_writer, read_json_stream

BASE = {
    "event_uuid": "u1", "event_time": "2026-01-05T10:00:00Z", "game_id": "g",
    "user_id": "player-1", "session_id": "s", "category": "Business",
    "amount": 99, "signup_date": "2026-01-01",
}


def line(**kw):
    d = dict(BASE)
    d.update(kw)
    return json.dumps(d)


def test_decode_edge_cases(spark):
    lines = [
        line(event_uuid="ok"),
        "not json",
        None,
        line(event_uuid="offset", event_time="2026-01-05T10:00:00+05:30"),
        line(event_uuid="garbage-time", event_time="yesterday"),
        line(event_uuid="text-amount", amount="7"),
        line(event_uuid="frac-amount", amount=7.5),
        line(event_uuid="extra", unknown_field=1),
        line(event_uuid=123),
        line(event_uuid="no-session", session_id=None),
        line(event_uuid="bad-cat", category="telemetry"),
        line(event_uuid="trim-cat", category="  Progression "),
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    out = {r.event_uuid: r for r in ingest(raw, "salt", dedup="none").collect()}
    assert set(out) == {"ok", "offset", "text-amount", "frac-amount", "extra", "123", "trim-cat"}
    assert out["offset"].event_time == dt.datetime(2026, 1, 5, 4, 30)
    assert out["offset"].event_date == dt.date(2026, 1, 5)
    assert out["text-amount"].amount is None and out["frac-amount"].amount is None
    assert out["ok"].category == "business" and out["trim-cat"].category == "progression"
    assert out["ok"].ingested_at is not None
    assert list(ingest(raw, "salt").columns) == CURATED_EVENT_COLUMNS
    # a malformed message decodes to a row of nulls
    nulls = decode_events(raw).filter(F.col("event_uuid").isNull()).count()
    assert nulls == 2  # "not json" and the null value (the numeric 123 becomes text)


def test_batch_dedup_keeps_one(spark):
    raw = spark.createDataFrame([(line(event_uuid="a"),), (line(event_uuid="a"),), (line(event_uuid="b"),)], "value string")
    assert ingest(raw, "s").count() == 2
    assert ingest(raw, "s", dedup="state").count() == 2
    assert ingest(raw, "s", dedup="none").count() == 3
    with pytest.raises(ValueError):
        ingest(raw, "s", dedup="other")


def _run(spark, src, out, ck, dedup):
    curated = ingest(read_json_stream(spark, src), "salt", dedup=dedup)
    ingest_writer(curated, ck, available_now=True).start(out).awaitTermination()
    return sorted((r.event_uuid, r.event_time) for r in spark.read.parquet(out).collect())


def _drop_file(src, name, rows):
    with open(os.path.join(src, name), "w") as f:
        for r in rows:
            f.write(line(**r) + "\n")


@pytest.mark.parametrize("dedup", ["watermark", "state"])
def test_stream_dedup_watermark_and_recovery(spark, tmp_dir, dedup):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    t = lambda s: f"{s}Z"
    # run 1: duplicate inside one batch
    _drop_file(src, "a.json", [
        dict(event_uuid="e1", event_time=t("2024-01-01T00:00:00")),
        dict(event_uuid="e1", event_time=t("2024-01-01T00:00:00")),
        dict(event_uuid="e2", event_time=t("2024-01-05T00:00:00")),
    ])
    got = _run(spark, src, out, ck, dedup)
    assert [u for u, _ in got] == ["e1", "e2"]
    # run 2 (restart from checkpoint): e1 is behind the watermark (01-04) -> dropped;
    # e2 again is a duplicate across batches -> dropped; e3 is on time
    _drop_file(src, "b.json", [
        dict(event_uuid="e1", event_time=t("2024-01-01T00:00:00")),
        dict(event_uuid="e2", event_time=t("2024-01-05T00:00:00")),
        dict(event_uuid="e3", event_time=t("2024-01-04T12:00:00")),
    ])
    got = _run(spark, src, out, ck, dedup)
    assert [u for u, _ in got] == ["e1", "e2", "e3"]
    # run 3: time moves on (watermark 01-09), run 4: e2 re-sent with a later event time
    _drop_file(src, "c.json", [dict(event_uuid="e4", event_time=t("2024-01-10T00:00:00"))])
    _run(spark, src, out, ck, dedup)
    _drop_file(src, "d.json", [dict(event_uuid="e2", event_time=t("2024-01-09T12:00:00"))])
    got = [u for u, _ in _run(spark, src, out, ck, dedup)]
    if dedup == "watermark":
        assert got == ["e1", "e2", "e2", "e3", "e4"]  # state expired: admitted again
    else:
        assert got == ["e1", "e2", "e3", "e4"]  # state never expires


def test_stream_equals_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    rows = [dict(event_uuid=f"e{i}", event_time=f"2024-01-0{1 + i % 5}T10:00:00Z") for i in range(40)]
    _drop_file(src, "a.json", rows + rows[:10])
    got = _run(spark, src, out, ck, "watermark")
    batch = ingest(spark.read.text(src), "salt")
    assert got == sorted((r.event_uuid, r.event_time) for r in batch.collect())
    assert len(got) == 40


def test_canonicalize_vendor_export(spark):
    from playpulse.operators.decode import canonicalize_events

    vendor = spark.createDataFrame(
        [("x1", "2024-01-01 10:00:00", "u9", "Purchase", 499, "2023-12-31"),
         ("x2", "2024-01-01 11:00:00", "u9", "heartbeat", None, "2023-12-31")],
        "id string, at string, who string, kind string, cents long, joined string",
    )
    env = canonicalize_events(
        vendor,
        {"event_uuid": "id", "event_time": F.col("at"), "user_id": "who", "category": "kind",
         "amount": "cents", "signup_date": "joined", "game_id": F.lit("g"),
         "session_id": F.concat(F.col("who"), F.lit("-s"))},
        {"purchase": "business"},
    )
    assert env.columns[:6] == ["event_uuid", "event_time", "game_id", "user_id", "session_id", "category"]
    rows = {r.event_uuid: r for r in env.collect()}
    assert rows["x1"].category == "business" and rows["x2"].category == "heartbeat"
    from playpulse.sources.fixtures import envelope_to_json

    curated = ingest(envelope_to_json(env), "s").collect()
    assert [r.event_uuid for r in curated] == ["x1"]  # unsupported category rejected
    with pytest.raises(ValueError):
        canonicalize_events(vendor, {"nope": "id"})


def test_start_ingest_with_rocksdb_state(spark, tmp_dir):
    from playpulse.config import JobConfig
    from playpulse.streaming.ingest import STATE_PROVIDER_KEY, start_ingest

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _drop_file(src, "a.json", [dict(event_uuid=f"e{i % 7}") for i in range(20)])
    cfg = JobConfig(warehouse=tmp_dir, player_salt="salt", checkpoint_location=os.path.join(tmp_dir, "ck"))
    previous = spark.conf.get(STATE_PROVIDER_KEY, None)
    try:
        start_ingest(read_json_stream(spark, src), cfg, available_now=True).awaitTermination()
        assert "RocksDB" in spark.conf.get(STATE_PROVIDER_KEY)
    finally:
        if previous:
            spark.conf.set(STATE_PROVIDER_KEY, previous)
        else:
            spark.conf.unset(STATE_PROVIDER_KEY)
    out = spark.read.parquet(cfg.table_path(cfg.raw_table))
    assert out.count() == 7
    with pytest.raises(ValueError):
        start_ingest(read_json_stream(spark, src), JobConfig(warehouse=tmp_dir))


def test_state_partitions_fixed_at_start_and_restored(spark, tmp_dir):
    from playpulse.streaming.ingest import state_partitions

    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    _drop_file(src, "a.json", [dict(event_uuid=f"e{i % 3}") for i in range(9)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 2):
        q = ingest_writer(ingest(read_json_stream(spark, src), "s"), ck, available_now=True).start(out)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    q.awaitTermination()
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert ops and all(o["numShufflePartitions"] == 2 for o in ops)
    assert spark.read.parquet(out).count() == 3
