"""Level progression funnel and virtual economy flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import suppress_small_groups
from playpulse.functions.rules import safe_rate
from playpulse.schema import (
    DAILY_DIMENSIONS,
    ECONOMY_FLOWS_COLUMNS,
    LEVEL_PROGRESSION_COLUMNS,
)

_STATUS_COLUMNS = {"start": "players_started", "fail": "players_failed", "complete": "players_completed"}


def build_progression_funnel(
    events: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Distinct players who started, failed and completed each level per day and
    dimensions; ``completion_rate = completed / started`` (0.0 without starts, and
    above 1 when players complete without a start that day).

    Planned as two plain aggregates instead of three distinct counts: first one row per
    (group, level, player) with a 0/1 flag per status, then a sum per (group, level).
    That is one shuffle keyed on the player plus a tiny one, with no row expansion.
    """
    has_player = F.col("player_key").isNotNull()
    per_player = (
        events.filter((F.col("category") == "progression") & F.col("progression_01").isNotNull())
        .groupBy(*DAILY_DIMENSIONS, F.col("progression_01").alias("level"), "player_key")
        .agg(
            *[
                F.max(
                    F.when((F.col("progression_status") == status) & has_player, 1).otherwise(0)
                ).alias(name)
                for status, name in _STATUS_COLUMNS.items()
            ]
        )
    )
    funnel = per_player.groupBy(*DAILY_DIMENSIONS, "level").agg(
        *[F.sum(name).cast("long").alias(name) for name in _STATUS_COLUMNS.values()]
    )
    funnel = funnel.withColumn(
        "completion_rate", safe_rate("players_completed", "players_started")
    ).select(*LEVEL_PROGRESSION_COLUMNS)
    return suppress_small_groups(funnel, "players_started", minimum_group_size)


def build_economy_flows(
    events: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Resource events per day, dimensions, virtual currency and item type: distinct
    players, currency sourced, currency sunk and the net flow. Amounts of an unknown
    flow type add to neither side; a null amount counts as 0."""
    amount = F.coalesce(F.col("amount"), F.lit(0).cast("long"))
    flows = (
        events.filter(F.col("category") == "resource")
        .groupBy(*DAILY_DIMENSIONS, "virtual_currency", "item_type")
        .agg(
            F.countDistinct("player_key").alias("supporting_players"),
            F.sum(F.when(F.col("flow_type") == "source", amount).otherwise(F.lit(0))).cast("long").alias("currency_source"),
            F.sum(F.when(F.col("flow_type") == "sink", amount).otherwise(F.lit(0))).cast("long").alias("currency_sink"),
        )
        .withColumn("net_currency_flow", F.col("currency_source") - F.col("currency_sink"))
        .select(*ECONOMY_FLOWS_COLUMNS)
    )
    return suppress_small_groups(flows, "supporting_players", minimum_group_size)
