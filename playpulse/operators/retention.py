"""Cohort retention (by signup day and breakdown), player activity days and activity masks.

A player's activity is kept as one row per attribute set: a bit for each of the days 0 to
``LAST_DAY`` since signup, and the number of active days outside of them. A day's change sets
and clears bits, so cohorts follow from these rows and not from the history of all days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import suppress_small_groups
from playpulse.functions.rules import safe_rate
from playpulse.schema import BREAKDOWN_DIMENSIONS, COHORT_RETENTION_COLUMNS

RETENTION_DAYS = (1, 7, 30)
LAST_DAY = 30
_ATTRIBUTES = ["signup_date", *BREAKDOWN_DIMENSIONS]
_PLAYER = ["game_id", "player_key", *_ATTRIBUTES]


def player_activity_days(events: DataFrame, clustered: bool = False) -> DataFrame:
    """One row per (game, player, active day) with ``day_number`` since signup.

    Rows without a signup date are ignored. When a player shows several attribute sets
    on one day (two builds, say), the set of the day's earliest event decides the day's
    signup date, platform, build and country; an exact time tie goes to the lowest
    attribute values (nulls first). Deterministic.

    Plan: a hash aggregate per (game, player, day, attribute set) keeps only the set's
    earliest time (a fixed-width buffer, reduced map side: one row per set and task);
    the pick between sets then runs on those few rows. Carrying the row id for the
    tie-break would turn the first step into a sort-based aggregate over every event.

    ``clustered``: the events come from a table in buckets by player, which all steps keep.
    """
    firsts = (
        events.filter(F.col("signup_date").isNotNull())
        .groupBy("game_id", "player_key", "event_date", *_ATTRIBUTES)
        .agg(F.min("event_time").alias("first_time"))
    )
    pick = F.min_by(
        F.struct(*[F.col(c) for c in _ATTRIBUTES]),
        F.struct(F.col("first_time"), *[F.col(c) for c in _ATTRIBUTES]),
    )
    if not clustered:  # one shuffle on the player serves this aggregate and the one per player after it
        firsts = firsts.repartition("game_id", "player_key")
    return (
        firsts.groupBy("game_id", "player_key", "event_date")
        .agg(pick.alias("first"))
        .select("game_id", "player_key", "event_date", *[F.col(f"first.{c}").alias(c) for c in _ATTRIBUTES])
        .withColumn("day_number", F.datediff(F.col("event_date"), F.col("signup_date")))
    )


def player_retention_flags(events: DataFrame) -> DataFrame:
    """Per (game, player, signup, platform, build, country): 1 when the player was
    active exactly 1, 7 and 30 days after signup, else 0."""
    return flags_of_days(player_activity_days(events))


def flags_of_days(days: DataFrame) -> DataFrame:
    """:func:`player_retention_flags` from (stored) player activity days."""
    return days.groupBy("game_id", "player_key", *_ATTRIBUTES).agg(
        *[
            F.max(F.when(F.col("day_number") == n, 1).otherwise(0)).alias(f"retained_d{n}")
            for n in RETENTION_DAYS
        ]
    )


def build_retention(
    events: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """Cohort size, retained players and D1/D7/D30 rates per (game, signup day, platform,
    build, country). Young cohorts count as not retained (no eligibility cut-off).

    A player appears once per cohort row by construction, so ``count`` is the distinct
    count without a distinct aggregate. Three shuffles, each of rows already reduced map
    side: (player-day, attribute set), player, cohort.
    """
    return retention_of_days(player_activity_days(events), minimum_group_size)


def retention_of_days(
    days: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """:func:`build_retention` from (stored) player activity days."""
    return cohorts(flags_of_days(days), minimum_group_size)


def activity_of_days(days: DataFrame) -> DataFrame:
    """Activity masks of all of a player's days: (game, player, attributes, ``days``, ``other_days``)."""
    return _masks(days).select(*_PLAYER, "days", "other_days")


def _masks(days: DataFrame) -> DataFrame:
    inside = F.col("day_number").between(0, LAST_DAY)
    return days.groupBy(*_PLAYER).agg(
        F.coalesce(F.bit_or(F.when(inside, F.expr("shiftleft(1L, day_number)"))), F.lit(0)).cast("long").alias("days"),
        F.count_if(~inside).cast("int").alias("other_days"),
    )


def activity_change(old_days: DataFrame, new_days: DataFrame) -> DataFrame:
    """What replacing ``old_days`` by ``new_days`` (the same days) does to activity masks: bits to
    clear, bits to set, change of ``other_days``; a row per player and attribute set with a change."""
    zero = F.lit(0).cast("long")
    old = _masks(old_days).select(*_PLAYER, F.col("days").alias("cleared"), zero.alias("added"), (-F.col("other_days")).alias("other_days"))
    new = _masks(new_days).select(*_PLAYER, zero.alias("cleared"), F.col("days").alias("added"), "other_days")
    return old.unionByName(new).groupBy(*_PLAYER).agg(
        F.bit_or("cleared").alias("cleared"), F.bit_or("added").alias("added"), F.sum("other_days").cast("int").alias("other_days")
    ).where("cleared != added OR other_days != 0")


def merge_activity(activity: DataFrame, change: DataFrame) -> DataFrame:
    """``activity`` after a change; players without a day left are gone. Rows meet by grouping, so null attributes do too."""
    zero = F.lit(0).cast("long")
    rows = activity.select(*_PLAYER, "days", zero.alias("cleared"), zero.alias("added"), "other_days").unionByName(
        change.select(*_PLAYER, zero.alias("days"), "cleared", "added", "other_days")
    )
    kept = F.bit_or("days").bitwiseAND(F.bitwise_not(F.bit_or("cleared")))
    merged = rows.groupBy(*_PLAYER).agg(kept.bitwiseOR(F.bit_or("added")).alias("days"), F.sum("other_days").cast("int").alias("other_days"))
    return merged.where("days != 0 OR other_days != 0")


def retention_of_activity(
    activity: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """:func:`build_retention` from activity masks, which are one row per player of a cohort already."""
    bit = lambda n: F.when(F.col("days").bitwiseAND(F.lit(1 << n)) != 0, 1).otherwise(0)
    return cohorts(activity.select(*_PLAYER, *[bit(n).alias(f"retained_d{n}") for n in RETENTION_DAYS]), minimum_group_size)


def cohorts(flags: DataFrame, minimum_group_size: int) -> DataFrame:
    """Cohort rows from :func:`player_retention_flags`."""
    cohort = flags.groupBy(
        "game_id", F.col("signup_date").alias("cohort_date"), *BREAKDOWN_DIMENSIONS
    ).agg(
        F.count("player_key").alias("cohort_size"),
        *[
            F.sum(f"retained_d{n}").cast("long").alias(f"retained_d{n}_players")
            for n in RETENTION_DAYS
        ],
    )
    for n in RETENTION_DAYS:
        cohort = cohort.withColumn(
            f"d{n}_retention", safe_rate(f"retained_d{n}_players", "cohort_size")
        )
    return suppress_small_groups(
        cohort.select(*COHORT_RETENTION_COLUMNS), "cohort_size", minimum_group_size
    )
