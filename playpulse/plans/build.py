"""Build the five analytical tables from the curated event table."""

from __future__ import annotations

import datetime as _dt
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playpulse.config import (
    DEFAULT_MINIMUM_PRIVACY_GROUP,
    JobConfig,
    argument,
    build_session,
    scratch,
)
from playpulse.operators.engagement import build_daily_engagement
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel
from playpulse.operators.retention import (
    activity_change,
    activity_of_days,
    merge_activity,
    player_activity_days,
    retention_of_activity,
    retention_of_days,
)
from playpulse.operators.sessions import session_facts
from playpulse.schema import PLAYER_SESSIONS_COLUMNS
from playpulse.sources.files import delete, exists, has_files, touch
from playpulse.sources.tables import (
    ensure_table,
    in_days,
    location_of,
    observed_days,
    read_table_path,
    replace_partitions,
    write_table,
)

TABLES = ("player_sessions", "daily_engagement", "cohort_retention", "level_progression", "economy_flows")
KEPT = ("player_days", "player_activity")  # what retention is kept in between runs


def tables_at(spark: SparkSession, config: JobConfig) -> dict[str, str]:
    """Where the job's tables are; those of a catalog are created if they are missing."""
    for t in (*TABLES, *KEPT):
        ensure_table(spark, config.table_at(t), t, config.table_path(t), config.buckets)
    return {t: config.table_at(t) for t in (*TABLES, *KEPT)}


@dataclass
class BuiltTables:
    """Where the tables are, the days that were built, and the cohorts that were (None: all)."""

    paths: dict[str, str]
    days: set[_dt.date]
    cohorts: set[_dt.date] | None


def curated_at(spark: SparkSession, config: JobConfig) -> str:
    """Where the curated table is; one of a catalog is created if it is missing."""
    ensure_table(spark, config.table_at(config.curated_table), "game_events", config.table_path(config.curated_table), config.buckets)
    return config.table_at(config.curated_table)


def landing_at(spark: SparkSession, config: JobConfig) -> str:
    """Where the landing table is; one of a catalog is created if it is missing, without buckets, which a stream can't write."""
    ensure_table(spark, config.table_at(config.raw_table), "game_events", config.table_path(config.raw_table), buckets=0)
    return config.table_at(config.raw_table)


def _in_range(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is None or end is None:
        return events
    return events.filter(F.col("event_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def build_tables(
    events: DataFrame,
    minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP,
    start: str | None = None,
    end: str | None = None,
    facts: DataFrame | None = None,
    player_days: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The five tables as DataFrames (not yet written).

    ``start``/``end`` restrict the day-grained tables to a date range (a daily run).
    Retention needs the full history, since a cohort's day-30 activity lies 30 days after
    its signup: ``player_days`` are the stored player activity days, without which they
    come from ``events``. ``facts`` are precomputed session facts of the range.
    """
    day_events = _in_range(events, start, end)
    if facts is None:
        facts = session_facts(day_events)
    return {
        "player_sessions": facts.select(*PLAYER_SESSIONS_COLUMNS),
        "daily_engagement": build_daily_engagement(facts, minimum_group_size=minimum_group_size),
        "cohort_retention": retention_of_days(
            player_activity_days(events) if player_days is None else player_days, minimum_group_size
        ),
        "level_progression": build_progression_funnel(day_events, minimum_group_size),
        "economy_flows": build_economy_flows(day_events, minimum_group_size),
    }


def build_and_write(
    spark: SparkSession,
    events: DataFrame,
    paths: dict[str, str],
    minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP,
    start: str | None = None,
    end: str | None = None,
    mode: str = "static",
    clustered: bool = False,
) -> BuiltTables:
    """Compute and write all five tables, and the player days and activity masks behind retention.

    Without a range every table is rebuilt from all of ``events`` (``mode="static"``, or
    ``"dynamic"`` to leave days without events as they are). With ``start``/``end`` the days of
    the range that have events are replaced; a day that ``events`` no longer holds keeps what
    was built of it. Player days and masks are kept in ``paths["player_days"]`` and
    ``paths["player_activity"]`` (default: beside the sessions). Of the cohorts only those are
    read and rewritten that have a player whose days changed.

    Session facts are computed once, written to the shared checkpoint folder (which
    cuts the lineage: a lost executor recomputes from those files, not from the raw
    events), and both the sessions table and engagement read them. Writes that don't wait for
    one another run as concurrent jobs. ``clustered``: see :func:`player_activity_days`.
    """
    beside = paths["player_sessions"].rstrip("/")
    paths = {"player_days": f"{beside}_days", "player_activity": f"{beside}_activity", **paths}
    ranged = start is not None and end is not None
    day_events = _in_range(events, start, end)
    player_days = player_activity_days(day_events, clustered)
    with scratch(spark) as s, ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
        facts_path, days_path = s.path("session-facts"), s.path("player-days")
        seen = Observation()
        facts = session_facts(day_events).observe(seen, F.collect_set("event_date").alias("days"))
        if ranged:
            new_days = pool.submit(player_days.write.parquet, days_path)
        else:
            write_days = pool.submit(write_table, player_days, "player_days", paths["player_days"], mode)
        facts.write.mode("overwrite").parquet(facts_path)
        present = observed_days(seen, "days")
        outputs = build_tables(
            events, minimum_group_size, start, end, facts=spark.read.schema(facts.schema).parquet(facts_path), player_days=player_days
        )

        def write(name: str) -> None:
            if ranged:
                replace_partitions(outputs[name], name, paths[name], present)
            else:
                write_table(outputs[name], name, paths[name], mode)

        def retention() -> set[_dt.date] | None:
            if not ranged:
                write_days.result()
                return rebuild_cohorts(spark, paths, minimum_group_size)
            new_days.result()
            days = spark.read.schema(player_days.schema).parquet(days_path)
            return replace_cohorts(spark, days, present, paths, minimum_group_size)

        # The writes are independent: submitted together, their stages share the
        # executors instead of queueing behind each other's tail tasks.
        changed = pool.submit(retention)
        futures = [pool.submit(write, n) for n in TABLES if n != "cohort_retention"]
        for f in futures:
            f.result()  # re-raises a failed write
        return BuiltTables(paths, present, changed.result())


def rebuild_cohorts(spark: SparkSession, paths: dict[str, str], minimum_group_size: int) -> None:
    """Activity masks and cohorts from all stored player days."""
    days = read_table_path(spark, paths["player_days"], "player_days")
    write_table(activity_of_days(days), "player_activity", paths["player_activity"], "static")
    activity = read_table_path(spark, paths["player_activity"], "player_activity")
    write_cohorts(spark, activity, paths, minimum_group_size)
    delete(spark, pending_mark(spark, paths))


def write_cohorts(spark: SparkSession, activity: DataFrame, paths: dict[str, str], minimum_group_size: int) -> None:
    """All cohorts from all masks; the threshold that they were written with is noted beside them."""
    write_table(retention_of_activity(activity, minimum_group_size), "cohort_retention", paths["cohort_retention"], "static")
    noted = threshold_mark(spark, paths, minimum_group_size)
    delete(spark, noted.rpartition("/")[0])
    touch(spark, noted)


def threshold_mark(spark: SparkSession, paths: dict[str, str], minimum_group_size: int) -> str:
    return f"{location_of(spark, paths['player_activity']).rstrip('/')}_threshold/{minimum_group_size}"


def pending_mark(spark: SparkSession, paths: dict[str, str]) -> str:
    """Present while player days and masks may disagree: a run that ended in between left it."""
    return f"{location_of(spark, paths['player_activity']).rstrip('/')}_pending"


def replace_cohorts(
    spark: SparkSession, days: DataFrame, present: set[_dt.date], paths: dict[str, str], minimum_group_size: int
) -> set[_dt.date] | None:
    """Replace the stored player days of the days ``present`` by ``days`` and bring masks and cohorts up to date.

    Old and new days are compared first; only the signup days of players with a change are
    read from the masks, merged and written, and only their cohorts are computed. The signup
    days come to the driver (one value a day of the game's life). Returns them, or None where
    all cohorts were rebuilt: from all days at the first run and after a run that ended between
    the writes, from all masks after a change of ``minimum_group_size``.
    """
    mark = pending_mark(spark, paths)
    activity_location = location_of(spark, paths["player_activity"])
    whole = exists(spark, mark) or not has_files(spark, activity_location)
    with scratch(spark) as s:
        if not whole:
            change_path, merged_path = s.path("activity-change"), s.path("activity")
            old = read_table_path(spark, paths["player_days"], "player_days").where(in_days("event_date", present))
            change = activity_change(old, days)
            change.write.parquet(change_path)
            change = spark.read.schema(change.schema).parquet(change_path)
            changed = {r[0] for r in change.select("signup_date").distinct().collect()}
        touch(spark, mark)
        replace_partitions(days, "player_days", paths["player_days"], present)
        if whole:
            return rebuild_cohorts(spark, paths, minimum_group_size)
        if changed:
            activity = read_table_path(spark, paths["player_activity"], "player_activity").where(in_days("signup_date", changed))
            merged = merge_activity(activity, change)
            merged.write.parquet(merged_path)
            merged = spark.read.schema(merged.schema).parquet(merged_path)
            replace_partitions(merged, "player_activity", paths["player_activity"], changed)
        if not exists(spark, threshold_mark(spark, paths, minimum_group_size)):
            write_cohorts(spark, read_table_path(spark, paths["player_activity"], "player_activity"), paths, minimum_group_size)
            changed = None
        elif changed:
            replace_partitions(retention_of_activity(merged, minimum_group_size), "cohort_retention", paths["cohort_retention"], changed)
        delete(spark, mark)
        return changed


def main(argv: list[str] | None = None) -> int:
    """Rebuild all five tables from the whole curated table, or with ``--start= --end=`` the
    days of a range."""
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    spark = build_session("playpulse-build")
    events = read_table_path(spark, curated_at(spark, config), "game_events")
    start = argument(argv, "start", "") or None
    end = argument(argv, "end", "") or None
    mode = argument(argv, "mode", "static")
    paths = tables_at(spark, config)
    build_and_write(spark, events, paths, config.minimum_privacy_group, start, end, mode, config.catalog is not None)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
