"""Schemas and key lists shared by every job.

Fixed values: the names, types and order of the columns are the contract with producers
of events and readers of the tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw event envelope, one JSON object per message / line. All fields come back nullable
# from ``from_json``; the ingest filters enforce the required ones.
RAW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_uuid", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("progression_status", T.StringType()),
        T.StructField("progression_01", T.StringType()),
        T.StructField("progression_02", T.StringType()),
        T.StructField("progression_03", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("flow_type", T.StringType()),
        T.StructField("virtual_currency", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("platform", T.StringType()),
        T.StructField("os_version", T.StringType()),
        T.StructField("build", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("signup_date", T.DateType()),
    ]
)

RAW_EVENT_FIELDS = [f.name for f in RAW_EVENT_SCHEMA.fields]

# Fields that must be present before an event enters the curated table.
REQUIRED_FIELDS = ["event_uuid", "event_time", "game_id", "user_id", "session_id"]

# Curated event table: envelope without user_id, plus derived columns.
CURATED_EVENT_COLUMNS = [c for c in RAW_EVENT_FIELDS if c != "user_id"] + [
    "event_date",
    "ingested_at",
    "player_key",
]

# Metric grain.
DAILY_DIMENSIONS = ["game_id", "event_date", "platform", "build", "country_code"]
BREAKDOWN_DIMENSIONS = ["platform", "build", "country_code"]

SESSION_KEYS = [
    "game_id",
    "player_key",
    "session_id",
    "event_date",
    "platform",
    "build",
    "country_code",
]

# Output column orders of the analytical tables.
PLAYER_SESSIONS_COLUMNS = SESSION_KEYS + [
    "session_started_at",
    "session_ended_at",
    "event_count",
    "has_error",
    "session_seconds",
]
DAILY_ENGAGEMENT_COLUMNS = DAILY_DIMENSIONS + [
    "dau",
    "sessions",
    "avg_session_seconds",
    "p95_session_seconds",
    "crash_free_session_rate",
    "revenue_usd",
]
COHORT_RETENTION_COLUMNS = ["game_id", "cohort_date"] + BREAKDOWN_DIMENSIONS + [
    "cohort_size",
    "retained_d1_players",
    "retained_d7_players",
    "retained_d30_players",
    "d1_retention",
    "d7_retention",
    "d30_retention",
]
LEVEL_PROGRESSION_COLUMNS = DAILY_DIMENSIONS + [
    "level",
    "players_started",
    "players_failed",
    "players_completed",
    "completion_rate",
]
ECONOMY_FLOWS_COLUMNS = DAILY_DIMENSIONS + [
    "virtual_currency",
    "item_type",
    "supporting_players",
    "currency_source",
    "currency_sink",
    "net_currency_flow",
]

# Table DDL (Spark SQL types), used to create empty tables and to check written output.
TABLE_DDL = {
    "game_events": (
        "event_uuid STRING, event_time TIMESTAMP, game_id STRING, session_id STRING, "
        "category STRING, event_id STRING, progression_status STRING, progression_01 STRING, "
        "progression_02 STRING, progression_03 STRING, currency STRING, amount BIGINT, "
        "item_type STRING, item_id STRING, flow_type STRING, virtual_currency STRING, "
        "severity STRING, message STRING, value DOUBLE, platform STRING, os_version STRING, "
        "build STRING, country_code STRING, signup_date DATE, event_date DATE, "
        "ingested_at TIMESTAMP, player_key STRING"
    ),
    "player_days": (
        "game_id STRING, player_key STRING, event_date DATE, signup_date DATE, platform STRING, "
        "build STRING, country_code STRING, day_number INT"
    ),
    "player_activity": (
        "game_id STRING, player_key STRING, signup_date DATE, platform STRING, build STRING, "
        "country_code STRING, days BIGINT, other_days INT"
    ),
    "event_ids": "id_hash BIGINT, id_check BIGINT, copies BIGINT, event_date DATE",
    "player_sessions": (
        "game_id STRING, player_key STRING, session_id STRING, event_date DATE, "
        "platform STRING, build STRING, country_code STRING, session_started_at TIMESTAMP, "
        "session_ended_at TIMESTAMP, event_count BIGINT, has_error INT, session_seconds BIGINT"
    ),
    "daily_engagement": (
        "game_id STRING, event_date DATE, platform STRING, build STRING, country_code STRING, "
        "dau BIGINT, sessions BIGINT, avg_session_seconds DOUBLE, p95_session_seconds BIGINT, "
        "crash_free_session_rate DOUBLE, revenue_usd DOUBLE"
    ),
    "cohort_retention": (
        "game_id STRING, cohort_date DATE, platform STRING, build STRING, country_code STRING, "
        "cohort_size BIGINT, retained_d1_players BIGINT, retained_d7_players BIGINT, "
        "retained_d30_players BIGINT, d1_retention DOUBLE, d7_retention DOUBLE, "
        "d30_retention DOUBLE"
    ),
    "level_progression": (
        "game_id STRING, event_date DATE, platform STRING, build STRING, country_code STRING, "
        "level STRING, players_started BIGINT, players_failed BIGINT, "
        "players_completed BIGINT, completion_rate DOUBLE"
    ),
    "economy_flows": (
        "game_id STRING, event_date DATE, platform STRING, build STRING, country_code STRING, "
        "virtual_currency STRING, item_type STRING, supporting_players BIGINT, "
        "currency_source BIGINT, currency_sink BIGINT, net_currency_flow BIGINT"
    ),
}

# Date column each table is partitioned by on disk (daily partitions: see README).
TABLE_PARTITION_COLUMN = {
    "game_events": "event_date",
    "player_days": "event_date",
    "player_activity": "signup_date",
    "event_ids": "event_date",
    "player_sessions": "event_date",
    "daily_engagement": "event_date",
    "cohort_retention": "cohort_date",
    "level_progression": "event_date",
    "economy_flows": "event_date",
}

# Catalog tables are bucketed too: rows of players by the player, so aggregates per player need no
# shuffle however hot their game is; metric rows by the game that they are read by.
BUCKETS = 16
TABLE_BUCKET_COLUMNS = {
    "game_events": ["player_key"],
    "player_days": ["player_key"],
    "player_activity": ["player_key"],
    "event_ids": ["id_hash", "id_check"],
    "player_sessions": ["player_key"],
    "daily_engagement": ["game_id"],
    "cohort_retention": ["game_id"],
    "level_progression": ["game_id"],
    "economy_flows": ["game_id"],
}

# Serving tables: partition key, clustering key and clustering direction of the date column.
SERVING_TABLES = {
    "daily_engagement_by_game_day": {
        "source": "daily_engagement",
        "partition_key": ["game_id", "activity_month"],
        "clustering_key": ["activity_date", "platform", "build", "country_code"],
        "date_column": "activity_date",
        "date_descending": True,
    },
    "cohort_retention_by_game_day": {
        "source": "cohort_retention",
        "partition_key": ["game_id", "cohort_month"],
        "clustering_key": ["cohort_date", "platform", "build", "country_code"],
        "date_column": "cohort_date",
        "date_descending": True,
    },
    "level_progression_by_game_day": {
        "source": "level_progression",
        "partition_key": ["game_id", "event_date"],
        "clustering_key": ["platform", "build", "country_code", "level"],
        "date_column": "event_date",
        "date_descending": False,
    },
    "economy_flows_by_game_day": {
        "source": "economy_flows",
        "partition_key": ["game_id", "event_date"],
        "clustering_key": ["platform", "build", "country_code", "virtual_currency", "item_type"],
        "date_column": "event_date",
        "date_descending": False,
    },
}


# Serving table columns (Spark SQL types).
SERVING_DDL = {
    "daily_engagement_by_game_day": (
        "game_id STRING, activity_month STRING, activity_date DATE, platform STRING, "
        "build STRING, country_code STRING, dau BIGINT, sessions BIGINT, "
        "avg_session_seconds DOUBLE, p95_session_seconds BIGINT, "
        "crash_free_session_rate DOUBLE, revenue_usd DOUBLE"
    ),
    "cohort_retention_by_game_day": (
        "game_id STRING, cohort_month STRING, cohort_date DATE, platform STRING, "
        "build STRING, country_code STRING, cohort_size BIGINT, retained_d1_players BIGINT, "
        "retained_d7_players BIGINT, retained_d30_players BIGINT, d1_retention DOUBLE, "
        "d7_retention DOUBLE, d30_retention DOUBLE"
    ),
    "level_progression_by_game_day": (
        "game_id STRING, event_date DATE, platform STRING, build STRING, country_code STRING, "
        "level STRING, players_started BIGINT, players_failed BIGINT, "
        "players_completed BIGINT, completion_rate DOUBLE"
    ),
    "economy_flows_by_game_day": (
        "game_id STRING, event_date DATE, platform STRING, build STRING, country_code STRING, "
        "virtual_currency STRING, item_type STRING, supporting_players BIGINT, "
        "currency_source BIGINT, currency_sink BIGINT, net_currency_flow BIGINT"
    ),
}


def serving_primary_key(table: str) -> list[str]:
    spec = SERVING_TABLES[table]
    return spec["partition_key"] + spec["clustering_key"]
