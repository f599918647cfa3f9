"""Job configuration and session construction.

Every job reads its settings from the environment (with defaults) and may be
overridden by ``--name=value`` arguments; see :func:`argument`.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from playpulse.schema import BUCKETS

DEFAULT_MINIMUM_PRIVACY_GROUP = 20
WRITE_BYTES = "256m"
FIRST_WIDTH = "2000"


class CatalogTable(str):
    """The name (``database.table``) of a table in Spark's catalog, wherever a path or a table is taken."""

    @property
    def database(self) -> str:
        return self.rpartition(".")[0]


@dataclass(frozen=True)
class JobConfig:
    """Settings shared by the ingest, build, publish and maintenance jobs.

    With ``catalog`` the tables are addressed by name in Spark's catalog: it is the prefix of
    the databases (``raw``, ``curated``, ``analytics``), may be empty, and the tables lie below
    the warehouse in ``buckets`` buckets. With ``replay_days`` a daily run counts the event ids
    that were sent before, up to so many days earlier (0: ever). A scan that keeps the buckets runs one task for each,
    so size their number to the cluster. Without it tables are plain folders.

    ``raw_table`` is the landing table: only the ingest stream writes to it.
    ``curated_table`` holds its closed days, rebalanced and sorted; gate, build and
    maintenance work on that one. A daily run takes its day and the ``lookback_days``
    before it anew, since late rows are admitted until the watermark passes them: the
    window must be no shorter than ``watermark`` (after an outage of the ingest, run
    with a longer one).
    """

    bootstrap_servers: str = "localhost:29092"
    topic: str = "gameplay-events"
    warehouse: str = "warehouse"
    raw_table: str = "raw/game_events"
    curated_table: str = "curated/game_events"
    lookback_days: int = 1
    analytics_namespace: str = "analytics"
    serving_namespace: str = "serving"
    checkpoint_location: str = "checkpoints/game-events"
    player_salt: str | None = None
    minimum_privacy_group: int = DEFAULT_MINIMUM_PRIVACY_GROUP
    serving_format: str = "parquet"
    serving_options: Mapping[str, str] = field(default_factory=dict)
    serving_delete_options: Mapping[str, str] | None = None  # what makes a keyed store delete the rows it is sent
    trigger_interval: str = "1 minute"
    watermark: str = "24 hours"
    dedup_mode: str = "watermark"
    state_store: str = "rocksdb"
    max_offsets_per_trigger: int | None = 10_000_000  # what one micro-batch, and so one dedup task, can receive
    state_partitions: int | None = None
    catalog: str | None = None
    buckets: int = BUCKETS
    replay_days: int | None = None

    def __post_init__(self) -> None:
        amount, unit = self.watermark.split()
        hours = float(amount) * {"day": 24, "hour": 1, "minute": 1 / 60, "second": 1 / 3600}[unit.rstrip("s")]
        if 24 * self.lookback_days < hours:
            raise ValueError(f"lookback_days={self.lookback_days} is shorter than the watermark of {self.watermark}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobConfig:
        env = os.environ if env is None else env
        d = cls()
        return cls(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", d.bootstrap_servers),
            topic=env.get("GAME_EVENT_TOPIC", d.topic),
            warehouse=env.get("WAREHOUSE_PATH", d.warehouse),
            raw_table=env.get("RAW_EVENT_TABLE", d.raw_table),
            curated_table=env.get("CURATED_EVENT_TABLE", d.curated_table),
            lookback_days=int(env.get("LOOKBACK_DAYS", str(d.lookback_days))),
            checkpoint_location=env.get("CHECKPOINT_LOCATION", d.checkpoint_location),
            player_salt=env.get("PLAYER_HASH_SALT") or None,
            minimum_privacy_group=int(
                env.get("MINIMUM_PRIVACY_GROUP", str(d.minimum_privacy_group))
            ),
            serving_format=env.get("SERVING_FORMAT", d.serving_format),
            serving_options=json.loads(env.get("SERVING_OPTIONS", "{}")),
            serving_delete_options=json.loads(env["SERVING_DELETE_OPTIONS"]) if env.get("SERVING_DELETE_OPTIONS") else None,
            dedup_mode=env.get("DEDUP_MODE", d.dedup_mode),
            state_store=env.get("STATE_STORE", d.state_store),
            max_offsets_per_trigger=int(env.get("MAX_OFFSETS_PER_TRIGGER", str(d.max_offsets_per_trigger))) or None,
            state_partitions=int(env["STATE_PARTITIONS"]) if env.get("STATE_PARTITIONS") else None,
            catalog=env.get("TABLE_CATALOG"),
            buckets=int(env.get("TABLE_BUCKETS", str(d.buckets))),
            replay_days=int(env["REPLAY_DAYS"]) if env.get("REPLAY_DAYS") else None,
        )

    def table_path(self, name: str) -> str:
        """Location of a table below the warehouse (``raw/..`` or an analytics name)."""
        if "/" in name:
            return _join(self.warehouse, name)
        return _join(self.warehouse, self.analytics_namespace, name)

    def table_at(self, name: str) -> str:
        """Where jobs find a table: its name in the catalog if there is one, else its path."""
        if self.catalog is None:
            return self.table_path(name)
        database, _, table = name.rpartition("/")
        return CatalogTable(f"{self.catalog}{database or self.analytics_namespace}.{table}")

    def serving_path(self, name: str) -> str:
        return _join(self.warehouse, self.serving_namespace, name)


def argument(args: Sequence[str], name: str, default: str) -> str:
    """Value of the option ``--name=value`` (or ``--name value``) in ``args``; the first one wins."""
    parser = argparse.ArgumentParser(add_help=False, allow_abbrev=False)
    parser.add_argument(f"--{name}", dest="values", action="append", default=[])
    return (parser.parse_known_args(list(args))[0].values or [default])[0]


def default_run_date(today: _dt.date | None = None) -> str:
    """Yesterday, the default run date of the daily jobs."""
    today = today or _dt.date.today()
    return (today - _dt.timedelta(days=1)).isoformat()


def build_session(
    app_name: str,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every job relies on.

    UTC session time zone (event times are UTC), adaptive execution with partition
    coalescing and skew-join splitting, and dynamic partition overwrite so a job that
    writes some dates leaves the other dates of a table alone. ``SHUFFLE_PARTITIONS``
    in the environment sets the shuffle width for large inputs; off a local master the
    first width of a shuffle is large, as adaptive execution can only merge partitions.
    The advisory size is that of rebalanced table writes, so files reach it.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": WRITE_BYTES,
    }
    shuffle = os.environ.get("SHUFFLE_PARTITIONS")
    if shuffle:
        # size to roughly (largest shuffle input) / 128-256 MB; adaptive execution
        # coalesces small partitions and splits skewed ones from there
        base["spark.sql.shuffle.partitions"] = shuffle
        base["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = shuffle
    base.update(conf or {})
    for k, v in base.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    first_width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if first_width not in base and not is_local(spark.sparkContext.master):
        spark.conf.set(first_width, FIRST_WIDTH)
    return spark


def is_local(master: str) -> bool:
    """Whether tasks run inside the driver (``local-cluster`` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def _join(*parts: str) -> str:
    head, *rest = parts
    out = head.rstrip("/")
    for p in rest:
        out = out + "/" + p.strip("/")
    return out


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and every executor can reach it; there a
    missing setting is an error. Only a local session gets a folder of its own, under the
    system temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="playpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder."""
    return _join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator["Scratch"]:
    """Scratch folders that are deleted at the end of the block, also after an error."""
    made = Scratch(spark)
    try:
        yield made
    finally:
        made.delete()


class Scratch:
    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def delete(self) -> None:
        from playpulse.sources.files import delete

        for p in self.paths:
            delete(self.spark, p)
