import datetime as dt
import os

from helpers import curated

from playpulse.config import JobConfig, argument, default_run_date, scratch_path, shared_dir
from playpulse.operators.sessions import build_sessions
from playpulse.sources.serving import write_keyed_store
from playpulse.sources.tables import create_table_sql, write_table


def test_config_from_env_and_arguments():
    cfg = JobConfig.from_env({"PLAYER_HASH_SALT": "x", "MINIMUM_PRIVACY_GROUP": "7", "WAREHOUSE_PATH": "/w"})
    assert (cfg.player_salt, cfg.minimum_privacy_group) == ("x", 7)
    assert cfg.table_path("daily_engagement") == "/w/analytics/daily_engagement"
    assert cfg.table_path("raw/game_events") == "/w/raw/game_events"
    assert JobConfig.from_env({}).player_salt is None
    assert argument(["--run-date=2024-01-02", "--run-date=x"], "run-date", "d") == "2024-01-02"
    assert argument([], "run-date", "d") == "d"
    assert default_run_date(dt.date(2024, 3, 1)) == "2024-02-29"


def test_shared_dir_comes_from_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base
    assert scratch_path(spark, "x").startswith(base + "/x-")


def test_create_table_and_query_through_catalog(spark, tmp_dir):
    loc = os.path.join(tmp_dir, "player_sessions")
    ev = curated(spark, [dict(session_id="a", event_time="2024-01-01 10:00:00"),
                         dict(session_id="b", event_time="2024-01-02 10:00:00")])
    write_table(build_sessions(ev), "player_sessions", loc, "static")
    spark.sql(create_table_sql("player_sessions", loc, "t_player_sessions"))
    spark.sql("ALTER TABLE t_player_sessions RECOVER PARTITIONS")
    got = spark.sql("SELECT session_id FROM t_player_sessions WHERE event_date = DATE '2024-01-02'").collect()
    assert [r.session_id for r in got] == ["b"]
    spark.sql("DROP TABLE t_player_sessions")


def test_keyed_store_writer_uses_configured_format(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    df = spark.createDataFrame([("g", 1)], "game_id string, dau long")
    write_keyed_store(df, "daily_engagement_by_game_day", "parquet", {"path": path})
    write_keyed_store(df, "daily_engagement_by_game_day", "parquet", {"path": path})
    assert spark.read.parquet(path).count() == 2  # a file format appends; a keyed store upserts


def test_shuffle_width_from_environment(spark, monkeypatch):
    from playpulse.config import build_session

    monkeypatch.setenv("SHUFFLE_PARTITIONS", "6")
    s = build_session("again")  # the running session, settings applied
    assert s.conf.get("spark.sql.shuffle.partitions") == "6"
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    import pytest

    from playpulse import config

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.shared_dir(Session())


def test_the_window_covers_the_watermark():
    import pytest

    JobConfig(watermark="36 hours", lookback_days=2)
    with pytest.raises(ValueError, match="watermark"):
        JobConfig(watermark="36 hours")


def test_scratch_is_deleted_after_an_error(spark):
    import os

    import pytest

    from playpulse.config import scratch

    with pytest.raises(RuntimeError):
        with scratch(spark) as s:
            path = s.path("x")
            spark.range(3).write.parquet(path)
            raise RuntimeError
    assert not os.path.exists(path)
