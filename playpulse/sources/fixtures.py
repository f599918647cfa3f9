"""Map the generic ``events`` table (event_id, ts, user_id, event_type, value, props)
onto the gameplay event envelope, so every job can run on it.

The same mapping is written once more as a DuckDB CTE in ``playpulse/oracle.py``;
keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.functions.privacy import pseudonymize_player_id
from playpulse.operators.decode import canonicalize_events
from playpulse.schema import CURATED_EVENT_COLUMNS, RAW_EVENT_SCHEMA

# Fixed values of the mapping: source event type -> category.
EVENT_TYPE_CATEGORY = {
    "signup": "user",
    "purchase": "business",
    "error": "error",
    "click": "progression",
    "view": "resource",
}
SIGNUP_BASE_DATE = "2023-12-30"
SESSION_BLOCK_MICROS = 21_600_000_000  # six hours
SESSION_SHIFT_MICROS = 10_800_000_000  # blocks start at 03:00 / 09:00 / 15:00 / 21:00 UTC

# Timestamp layout used when events are written as JSON (microseconds, UTC offset).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_to_envelope(events: DataFrame, translate_categories: bool = True) -> DataFrame:
    """Raw envelope (25 fields, raw ``user_id`` still present) from the generic table,
    via the vendor-to-canonical mapping operator.

    ``translate_categories=False`` keeps the source event type as the category, as an
    export lands when the category translation is skipped.
    """
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    is_click, is_buy, is_view = et == "click", et == "purchase", et == "view"
    level_seed = F.get_json_object(F.col("props"), "$.k").cast("int")
    block = F.floor((F.unix_micros(ts) + F.lit(SESSION_SHIFT_MICROS)) / F.lit(SESSION_BLOCK_MICROS))
    status = F.when(eid % 3 == 0, "start").when(eid % 3 == 1, "complete").otherwise("fail")
    fields = {
        "event_uuid": F.concat(F.lit("e-"), eid.cast("string")),
        "event_time": ts,
        "game_id": F.concat(F.lit("game-"), (uid % 5 == 4).cast("int").cast("string")),
        "user_id": F.concat(F.lit("player-"), uid.cast("string")),
        "session_id": F.concat(
            F.lit("player-"), uid.cast("string"), F.lit("-"), block.cast("long").cast("string")
        ),
        "category": et,
        "progression_status": F.when(is_click, status),
        "progression_01": F.when(
            is_click, F.concat(F.lit("level_"), (level_seed % 8).cast("string"))
        ),
        "currency": F.when(is_buy, F.lit("USD")),
        "amount": F.when(is_buy, F.round(F.col("value") * 100).cast("long")).when(
            is_view, F.round(F.col("value")).cast("long")
        ),
        "item_type": F.when(is_view, F.concat(F.lit("item_"), (eid % 2).cast("string"))),
        "flow_type": F.when(is_view, F.when(eid % 2 == 0, "source").otherwise("sink")),
        "virtual_currency": F.when(is_view, F.lit("credits")),
        "platform": F.when(uid % 2 == 0, "ios").otherwise("android"),
        "build": F.lit("1.0"),
        "country_code": F.when(uid % 5 == 0, "CA").otherwise("US"),
        "signup_date": F.date_add(F.lit(SIGNUP_BASE_DATE).cast("date"), (uid % 3).cast("int")),
    }
    return canonicalize_events(
        events, fields, EVENT_TYPE_CATEGORY if translate_categories else None
    )


def envelope_to_json(envelope: DataFrame, value_column: str = "value") -> DataFrame:
    """One JSON object per row in a string column, as a producer would send it."""
    fields = [F.col(f.name) for f in RAW_EVENT_SCHEMA.fields if f.name in envelope.columns]
    return envelope.select(
        F.to_json(F.struct(*fields), {"timestampFormat": JSON_TIMESTAMP_FORMAT}).alias(
            value_column
        )
    )


def curated_events(events: DataFrame, salt: str, translate_categories: bool = True) -> DataFrame:
    """Curated-table rows for the generic table, without the JSON round trip.

    Equal to ``ingest(envelope_to_json(events_to_envelope(events)), salt)`` minus
    ``ingested_at`` (set to null here): the generic table has unique ids and no
    missing fields, so validation and dedup remove nothing.
    """
    env = events_to_envelope(events, translate_categories)
    env = env.withColumn("event_date", F.to_date("event_time"))
    env = env.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    return pseudonymize_player_id(env, salt).select(*CURATED_EVENT_COLUMNS)


def load_curated(spark: SparkSession, sf_dir: str, salt: str) -> DataFrame:
    return curated_events(read_table(spark, sf_dir, "events"), salt)


def load_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic table as raw JSON lines (column ``value``), as an export file holds them."""
    return envelope_to_json(events_to_envelope(read_table(spark, sf_dir, "events")))

