"""Session facts: one row per (game, player, session, day, platform, build, country)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.schema import PLAYER_SESSIONS_COLUMNS, SESSION_KEYS


def session_facts(events: DataFrame) -> DataFrame:
    """Session rows plus ``revenue_cents`` (business amounts of the session).

    A session that crosses midnight gives one row per day. ``session_seconds`` is the
    whole-second span, never negative. ``revenue_cents`` lets daily engagement get its
    revenue from the session rows, so the event table is scanned once for both.

    Plan: one hash aggregate on the seven keys with a map-side partial step, so a hot
    session or player never ships its raw events through the shuffle.
    """
    is_business = F.col("category") == "business"
    return (
        events.groupBy(*SESSION_KEYS)
        .agg(
            F.min("event_time").alias("session_started_at"),
            F.max("event_time").alias("session_ended_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.max(F.when(F.col("category") == "error", F.lit(1)).otherwise(F.lit(0))).alias(
                "has_error"
            ),
            F.sum(F.when(is_business, F.coalesce(F.col("amount"), F.lit(0)))).alias(
                "revenue_cents"
            ),
        )
        .withColumn(
            "session_seconds",
            F.greatest(
                F.lit(0).cast("long"),
                F.unix_timestamp("session_ended_at") - F.unix_timestamp("session_started_at"),
            ),
        )
    )


def build_sessions(events: DataFrame) -> DataFrame:
    """The ``player_sessions`` table (12 columns)."""
    return session_facts(events).select(*PLAYER_SESSIONS_COLUMNS)
