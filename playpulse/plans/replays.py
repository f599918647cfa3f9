"""Replay job: index a day's event ids and count those that were sent on earlier days."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.config import JobConfig, argument, build_session, default_run_date
from playpulse.operators.replays import id_hashes, replays
from playpulse.plans.build import curated_at
from playpulse.sources.tables import ensure_table, read_table_path, replace_days

INDEX = "event_ids"


def index_at(spark: SparkSession, config: JobConfig) -> str:
    ensure_table(spark, config.table_at(INDEX), INDEX, config.table_path(INDEX), config.buckets)
    return config.table_at(INDEX)


def index_days(spark: SparkSession, config: JobConfig, start: str, end: str) -> None:
    """Index the curated table's days ``start`` .. ``end``; days that it doesn't hold keep their entries."""
    events = read_table_path(spark, curated_at(spark, config), "game_events")
    wanted = events.where(F.col("event_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    replace_days(id_hashes(wanted), INDEX, index_at(spark, config), start, end, drop_missing=False)


def replayed_on(spark: SparkSession, config: JobConfig, day: str) -> DataFrame:
    """(event_date, replayed_ids, replayed_rows) of an indexed day, against the ``replay_days``
    before it (0: all). Only the index is read, never the events."""
    ids, date = read_table_path(spark, index_at(spark, config), INDEX), F.to_date(F.lit(day))
    earlier = ids.where(F.col("event_date") < date)
    if config.replay_days:
        earlier = earlier.where(F.col("event_date") >= F.date_sub(date, config.replay_days))
    found = replays(ids.where(F.col("event_date") == date), earlier)
    return found.select(date.alias("event_date"), "replayed_ids", "replayed_rows")


def main(argv: list[str] | None = None) -> int:
    """``--run-date=YYYY-MM-DD`` (default yesterday): index that day and report what was sent again."""
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    spark = build_session("playpulse-replays")
    day = argument(argv, "run-date", default_run_date())
    index_days(spark, config, day, day)
    row = replayed_on(spark, config, day).first()
    print(f"{day}: {row['replayed_ids']} event ids of earlier days, {row['replayed_rows']} rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
