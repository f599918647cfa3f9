"""Publish the four aggregate tables to the serving store."""

from __future__ import annotations

import datetime as _dt
import sys
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.config import JobConfig, argument, build_session
from playpulse.operators.serving import SERVING_SHAPES, split_null_keys
from playpulse.plans.build import tables_at
from playpulse.schema import SERVING_TABLES, TABLE_PARTITION_COLUMN
from playpulse.sources.serving import ALL, publish
from playpulse.sources.tables import in_days, read_table_path


def serving_rows(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Serving shapes of the analytical tables (keyed by serving table name)."""
    return {
        serving: shape(tables[source]) for serving, (source, shape) in SERVING_SHAPES.items()
    }


Days = Collection[_dt.date] | None


def changed(table: str, days: Days, cohorts: Days) -> Days:
    """Which dates of a table a run changed (None: any)."""
    return cohorts if TABLE_PARTITION_COLUMN[table] == "cohort_date" else days


def of_days(rows: DataFrame, table: str, days: Days, cohorts: Days = None) -> DataFrame:
    """A table's rows of the dates that a run changed: ``days``, in cohort tables ``cohorts``."""
    dates = changed(table, days, cohorts)
    return rows if dates is None else rows.filter(in_days(TABLE_PARTITION_COLUMN[table], dates))


def publish_all(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    config: JobConfig,
    current_paths: dict[str, str] | None = None,
    new_paths: dict[str, str] | None = None,
    days: Days = None,
    cohorts: Days = None,
) -> dict[str, int]:
    """Publish every serving table; returns, per table, the number of rows left out for a
    null key part (they cannot be addressed in a keyed store).

    ``tables`` hold the rows of ``days``, cohort tables those of ``cohorts`` (None: of all),
    which replace the published ones of these dates. The four tables are independent and are published as concurrent jobs."""

    def one(name: str, rows: DataFrame) -> int:
        dates = changed(SERVING_TABLES[name]["source"], days, cohorts)
        _, bad = split_null_keys(rows, name)
        n = bad.count()
        publish(
            spark,
            rows,
            name,
            config,
            (current_paths or {}).get(name),
            (new_paths or {}).get(name),
            ALL if dates is None else dates,
        )
        return n

    rows_by_table = serving_rows(tables)
    with ThreadPoolExecutor(max_workers=len(rows_by_table)) as pool:
        futures = {name: pool.submit(one, name, rows) for name, rows in rows_by_table.items()}
        return {name: f.result() for name, f in futures.items()}


def present_days(sessions: DataFrame, start: str, end: str) -> set[_dt.date]:
    """The days of a range that were built: those that have sessions. Other days stay as they were published."""
    days = sessions.where(F.col("event_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return {r[0] for r in days.select("event_date").distinct().collect()}  # a day of the range each


def main(argv: list[str] | None = None) -> int:
    """Publish the four aggregate tables, all days or ``--start= --end=`` (Parquet: partitions
    replaced in place; with ``--version=`` new version directories instead, merged with
    ``--previous-version=``; a keyed store ignores both)."""
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    spark = build_session("playpulse-publish")
    version = argument(argv, "version", "") or None
    previous = argument(argv, "previous-version", "") or None
    start, end = argument(argv, "start", ""), argument(argv, "end", "")
    at = tables_at(spark, config)
    days = present_days(read_table_path(spark, at["player_sessions"], "player_sessions"), start, end) if start and end else None
    sources = {source for source, _ in SERVING_SHAPES.values()}
    tables = {t: of_days(read_table_path(spark, at[t], t), t, days) for t in sources}
    new = {s: f"{config.serving_path(s)}/{version}" for s in SERVING_TABLES} if version else None
    current = {s: f"{config.serving_path(s)}/{previous}" for s in SERVING_TABLES} if previous else None
    left_out = publish_all(spark, tables, config, current, new, days)
    for name, n in left_out.items():
        if n:
            print(f"{name}: {n} rows with a null key part left out")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
