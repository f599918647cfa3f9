"""Event ingest: decode -> validate -> pseudonymise -> watermark + dedup -> append.

:func:`ingest` is one transform for batch and streaming DataFrames with a string
``value`` column (Kafka ``value``, a text file line, ...). Dedup modes:

- ``"watermark"`` (default): ``dropDuplicatesWithinWatermark(["event_uuid"])``. Ids
  are remembered until the event-time watermark passes them, so state stays bounded;
  an id re-sent after the watermark is admitted again.
- ``"state"``: ``dropDuplicates(["event_uuid"])`` after ``withWatermark``: rows older
  than the watermark are dropped, but the key holds no event time, so the id state
  never expires (unbounded state; kept for exact compatibility).
- ``"none"``: no dedup (the quality gate then reports duplicates).

On a batch DataFrame both dedup modes are a plain ``dropDuplicates`` on the id.

In every mode rows whose event time is behind the watermark (24 hours by default) are
dropped by the stateful operator; the threshold is the previous micro-batch's
watermark. The raw player id is hashed *before* the dedup shuffle, so it never
crosses the network.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from playpulse.config import JobConfig
from playpulse.functions.privacy import pseudonymize_player_id
from playpulse.operators.decode import decode_events, validate_events
from playpulse.schema import CURATED_EVENT_COLUMNS
from playpulse.sources.tables import ensure_table
from playpulse.streaming.metrics import recorded

DEDUP_MODES = ("watermark", "state", "none")
DEFAULT_WATERMARK = "24 hours"
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Start streaming queries inside this block with ``n`` state (shuffle) partitions.

    A stream fixes its state partition count at its first start (it is recorded in
    the checkpoint); size it to the state, not to the session default. A started
    query keeps its own copy of the session settings, so the previous value is
    restored as soon as the block ends.
    """
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    if n:
        spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep dedup state in RocksDB (on local disk, checkpointed as changelogs) instead of
    the JVM heap: a day of event ids per state partition does not fit in memory at
    scale. Takes effect for queries started afterwards with a new checkpoint."""
    spark.conf.set(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def ingest(
    raw: DataFrame,
    salt: str,
    dedup: str = "watermark",
    watermark: str = DEFAULT_WATERMARK,
    value_column: str = "value",
    with_ingest_time: bool = True,
) -> DataFrame:
    """Curated event rows from raw JSON messages (batch or streaming input)."""
    if dedup not in DEDUP_MODES:
        raise ValueError(f"dedup must be one of {DEDUP_MODES}, got {dedup!r}")
    events = validate_events(decode_events(raw, value_column), with_ingest_time)
    events = pseudonymize_player_id(events, salt)
    if dedup != "none":
        events = events.withWatermark("event_time", watermark)
        if dedup == "watermark" and raw.isStreaming:
            events = events.dropDuplicatesWithinWatermark(["event_uuid"])
        else:
            events = events.dropDuplicates(["event_uuid"])
    return events.select(*CURATED_EVENT_COLUMNS)


def read_kafka_stream(spark: SparkSession, config: JobConfig, **options: str) -> DataFrame:
    """Kafka topic as a stream with a string ``value``; starts at the latest offsets and
    tolerates lost offsets. Needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", config.bootstrap_servers)
        .option("subscribe", config.topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if config.max_offsets_per_trigger:
        # bounds each micro-batch, and with it what one dedup task can receive
        reader = reader.option("maxOffsetsPerTrigger", str(config.max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_json_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """JSON-lines files landing in a folder, as a stream of ``value`` lines; a micro-batch takes a
    bounded number of files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def ingest_writer(
    curated: DataFrame,
    checkpoint_location: str,
    trigger_interval: str | None = "1 minute",
    available_now: bool = False,
    partition_by: str | None = "event_date",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataStreamWriter:
    """Append-mode writer with a checkpoint (exactly-once with a file or table sink)."""
    w = curated.writeStream.format(fmt).outputMode("append").option(
        "checkpointLocation", checkpoint_location
    )
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_interval:
        w = w.trigger(processingTime=trigger_interval)
    return w


def start_ingest(
    raw: DataFrame,
    config: JobConfig,
    path: str | None = None,
    table: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the ingest stream into a path or a catalog table (the long-running job).

    By default it is the landing table of the configuration. A catalog's landing table is not
    bucketed, which a stream can't write; it is created if it is missing.
    """
    if not config.player_salt:
        raise ValueError("PLAYER_HASH_SALT must be set")
    if config.state_store == "rocksdb":
        use_rocksdb_state(raw.sparkSession)
    curated = ingest(raw, config.player_salt, config.dedup_mode, config.watermark)
    w = ingest_writer(
        curated, config.checkpoint_location, config.trigger_interval, available_now
    )
    if path is None and table is None and config.catalog is not None:
        table = config.table_at(config.raw_table)
        ensure_table(raw.sparkSession, table, "game_events", config.table_path(config.raw_table), buckets=0)
    with state_partitions(raw.sparkSession, config.state_partitions):
        if table:
            return w.toTable(str(table))
        return w.start(path or config.table_path(config.raw_table))


def run_ingest(spark: SparkSession, config: JobConfig | None = None) -> None:
    """Entry point of the streaming job: Kafka -> landing table, until stopped; what each batch
    took in and dropped is kept beside the landing table."""
    config = config or JobConfig.from_env()
    query = start_ingest(read_kafka_stream(spark, config), config)
    recorded(spark, query, f"{config.table_path(config.raw_table)}_metrics")


if __name__ == "__main__":
    from playpulse.config import build_session

    run_ingest(build_session("playpulse-ingest"))
