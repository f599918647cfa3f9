"""The stored form of serving tables: row groups that a read skips, and deletions from a keyed store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playpulse import registry
from playpulse.config import JobConfig
from playpulse.operators.serving import read_serving, serving_engagement
from playpulse.schema import serving_primary_key
from playpulse.sources import serving as S

TABLE = "daily_engagement_by_game_day"


def rows_of(spark, games, days=(1, 2), platforms=("ios", "android")):
    schema = ("game_id string, event_date date, platform string, build string, country_code string, dau long, sessions long, "
              "avg_session_seconds double, p95_session_seconds long, crash_free_session_rate double, revenue_usd double")
    return serving_engagement(spark.createDataFrame(
        [(g, dt.date(2024, 1, d), p, "1", "US", 20, 1, 1.0, 1, 1.0, 0.0) for g in games for d in days for p in platforms], schema))


def scanned_rows(df):
    """Rows that the scan of a query gave out, after Parquet has skipped row groups."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would leave an empty scan out of the final plan
    try:
        df = df.select("*")
        df.collect()
        nodes, total = [df._jdf.queryExecution().executedPlan()], []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            total.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return sum(total)


@pytest.fixture()
def store(spark, tmp_dir):
    """Many games in one month, in row groups of few rows."""
    conf = spark._jsc.hadoopConfiguration()
    # names without a dictionary, as Parquet writes them where a row group has too many
    small = {"parquet.enable.dictionary#game_id": "false", "parquet.block.size": "4096", "parquet.page.size.row.check.min": "10", "parquet.page.size.row.check.max": "10", "parquet.page.row.count.limit": "50", "parquet.block.size.row.check.min": "50", "parquet.block.size.row.check.max": "50"}
    for k, v in small.items():
        conf.set(k, v)
    try:
        yield S.publish_partitions(spark, rows_of(spark, [f"game-{2 * i:05}" for i in range(3000)]), TABLE, f"{tmp_dir}/serving")
    finally:
        for k in small:
            conf.unset(k)


def test_a_read_of_one_game_skips_row_groups(spark, store):
    df = read_serving(store, TABLE, "game-01000", "2024-01")
    assert [(r.activity_date.day, r.platform) for r in df.collect()] == [(2, "android"), (2, "ios"), (1, "android"), (1, "ios")]
    assert 4 <= scanned_rows(df) < store.count() / 4


def test_a_bloom_filter_tells_of_a_game_that_is_not_there(spark, store):
    """Between two stored names their order can't tell: the filter alone says no."""
    plain = {"parquet.filter.dictionary.enabled": "false", "parquet.filter.columnindex.enabled": "false"}
    path = store.inputFiles()[0].rpartition("/activity_month=")[0]

    def scanned(bloom):
        rows = spark.read.schema(store.schema).options(**plain, **{"parquet.filter.bloom.enabled": bloom}).parquet(path)
        return [scanned_rows(read_serving(rows, TABLE, f"game-{n:05}", "2024-01")) for n in range(1001, 1031, 2)]

    assert sum(scanned("true")) == 0 and sum(scanned("false")) > 0


def test_a_version_directory_has_the_same_form(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    out = S.publish_parquet(spark, rows_of(spark, ["b", "a"]), TABLE, None, f"{tmp_dir}/v1")
    assert out.count() == 8
    for f in glob.glob(f"{tmp_dir}/v1/*.parquet"):
        t = pq.read_table(f).select(["game_id", "activity_date", "platform"]).to_pylist()
        assert t == sorted(t, key=lambda r: (r["game_id"], -r["activity_date"].toordinal(), r["platform"]))


def test_vanished_keys_are_deleted_from_a_keyed_store(spark, tmp_dir, monkeypatch):
    sent = []

    def write(df, table, fmt, options):
        sent.append((options.get("ttl"), sorted((r.game_id, r.activity_date.day, r.platform, r.dau) for r in df.collect())))

    monkeypatch.setattr(S, "write_keyed_store", write)
    env = {"SERVING_FORMAT": "store", "SERVING_OPTIONS": '{"keyspace": "k"}', "SERVING_DELETE_OPTIONS": '{"ttl": "1"}', "WAREHOUSE_PATH": tmp_dir}
    cfg = JobConfig.from_env(env)
    day = lambda d: [dt.date(2024, 1, d)]
    S.publish(spark, rows_of(spark, ["g", "h"]), TABLE, cfg, replace=S.ALL)
    assert [t for t, _ in sent] == [None]
    sent.clear()
    S.publish(spark, rows_of(spark, ["g"], (2,), ("ios",)), TABLE, cfg, replace=day(2))
    assert sent == [(None, [("g", 2, "ios", 20)]), ("1", [("g", 2, "android", None), ("h", 2, "android", None), ("h", 2, "ios", None)])]
    sent.clear()
    S.publish(spark, rows_of(spark, ["g"], (2,), ("ios",)), TABLE, cfg, replace=day(2))
    assert len(sent) == 1  # they are gone for good
    sent.clear()
    S.publish(spark, rows_of(spark, ["x"], (9,)), TABLE, cfg, replace=None)
    S.publish(spark, rows_of(spark, ["x"], (9,), ("ios",)), TABLE, cfg, replace=S.ALL)
    assert [t for t, _ in sent] == [None, None, "1"]
    assert {(g, d) for g, d, _, _ in sent[2][1]} == {("g", 1), ("h", 1), ("g", 2), ("x", 9)} and len(sent[2][1]) == 6
    known = S.read_serving_table(spark, cfg.serving_path(f"{TABLE}_keys"), TABLE)
    assert [tuple(r) for r in known.select("game_id", "platform").collect()] == [("x", "ios")]
    assert set(serving_primary_key(TABLE)) <= set(known.columns)


def test_a_store_that_is_sent_no_deletion(spark, tmp_dir):
    """All groups are above the privacy threshold: the second publication takes nothing away."""
    rows = [(i, dt.datetime(2024, 1, 2, 10, 0, i % 60), i, "view", 1.0, '{"k": 1}') for i in range(400)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_dir}/events.parquet")
    out = registry.SPARK["keyed_store_deletions"](spark, tmp_dir)
    assert out.columns == serving_primary_key(TABLE) and out.collect() == []


def test_a_publication_that_failed_forgets_no_key(spark, tmp_dir, monkeypatch):
    cfg = JobConfig(warehouse=tmp_dir, serving_format="store", serving_delete_options={"ttl": "1"})
    sent = []

    def fail(*_):
        raise RuntimeError("store is down")

    monkeypatch.setattr(S, "write_keyed_store", fail)
    with pytest.raises(RuntimeError):
        S.publish(spark, rows_of(spark, ["g", "h"]), TABLE, cfg, replace=S.ALL)
    monkeypatch.setattr(S, "write_keyed_store", lambda df, table, fmt, options: sent.append((options.get("ttl"), df.count())))
    S.publish(spark, rows_of(spark, ["g"]), TABLE, cfg, replace=S.ALL)
    assert sent == [(None, 4), ("1", 4)]  # part of the first may have reached the store
