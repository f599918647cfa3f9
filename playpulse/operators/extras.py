"""Views named in the event contract and architecture notes: monetisation per player,
the release (build) view and placement exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import suppress_small_groups
from playpulse.functions.rules import safe_rate
from playpulse.schema import DAILY_DIMENSIONS

# Categories of the placement / design view.
EXPOSURE_CATEGORIES = ("ad", "impression", "design")


def build_monetization(
    facts: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Per day and dimensions: active players, paying players (a business event that
    day), revenue, revenue per active player and per paying player. Input: session
    facts (with ``revenue_cents``)."""
    paying = F.when(F.col("revenue_cents").isNotNull(), F.col("player_key"))
    out = facts.groupBy(*DAILY_DIMENSIONS).agg(
        F.countDistinct("player_key").alias("dau"),
        F.countDistinct(paying).alias("paying_players"),
        (F.coalesce(F.sum("revenue_cents"), F.lit(0)) / F.lit(100.0)).alias("revenue_usd"),
    )
    out = out.withColumn("revenue_per_active_player", safe_rate("revenue_usd", "dau")).withColumn(
        "revenue_per_paying_player", safe_rate("revenue_usd", "paying_players")
    )
    return suppress_small_groups(out, "dau", minimum_group_size)


def build_release_view(
    sessions: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Per game, day and build, recounted from session rows (distinct counts do not add
    up across platforms or countries): active players, sessions, mean session seconds
    and crash-free session rate."""
    out = sessions.groupBy("game_id", "event_date", "build").agg(
        F.countDistinct("player_key").alias("dau"),
        F.countDistinct("session_id").alias("sessions"),
        F.avg("session_seconds").alias("avg_session_seconds"),
        (F.lit(1.0) - F.avg(F.col("has_error").cast("double"))).alias("crash_free_session_rate"),
    )
    return suppress_small_groups(out, "dau", minimum_group_size)


def build_placement_exposure(
    events: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Ad, impression and design events per day, dimensions, category and event id:
    events and distinct players."""
    out = (
        events.filter(F.col("category").isin(*EXPOSURE_CATEGORIES))
        .groupBy(*DAILY_DIMENSIONS, "category", "event_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("player_key").alias("players"),
        )
    )
    return suppress_small_groups(out, "players", minimum_group_size)
