"""Validation profile of a JSON-lines event export (file-level metrics).

Replaces a single-machine pass over a file with Spark aggregates: each metric is a
grouped or global aggregate over the parsed rows, so the work spreads over as many
tasks as the input has splits. Players and sessions are the raw ids in the file;
retention here is the *eligible-player* definition over the whole file (no game key),
which differs from the cohort table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import check_salt
from playpulse.functions.rules import SUPPORTED_CATEGORIES, normalize_category, percent
from playpulse.operators.decode import parse_json_fields

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("event_uuid", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("amount", T.LongType()),
        T.StructField("progression_01", T.StringType()),
        T.StructField("progression_status", T.StringType()),
        T.StructField("country_code", T.StringType()),
    ]
)

RETENTION_DAYS = (1, 7, 30)
TOP_LEVELS = 5
SAMPLE_KEYS = 5
# Fixed value: the group key used when a row has no country.
UNKNOWN = "unknown"


def parse_lines(lines: DataFrame, value_column: str = "value") -> DataFrame:
    """Parsed rows with an ``is_valid`` flag and the UTC ``event_day``.

    Valid: the line is a JSON object (a malformed line parses to nulls), the category
    (trimmed, lower case) is supported, event id, player and session are non-empty,
    and event time and signup date parse. A null id counts as missing.
    """
    parsed = parse_json_fields(lines, value_column, PROFILE_SCHEMA)
    non_empty = [F.coalesce(F.length(c) > 0, F.lit(False)) for c in ("event_uuid", "user_id", "session_id")]
    parsed = parsed.withColumn("category", normalize_category("category"))
    valid = reduce(
        lambda a, b: a & b,
        [
            F.coalesce(F.col("category").isin(*SUPPORTED_CATEGORIES), F.lit(False)),
            F.col("event_time").isNotNull(),
            F.col("signup_date").isNotNull(),
            *non_empty,
        ],
    )
    return parsed.withColumn("is_valid", valid).withColumn(
        "event_day", F.to_date("event_time")
    )


def hash_players(parsed: DataFrame, salt: str) -> DataFrame:
    """Parsed rows with the salted hash in place of the player id. Every metric counts players
    by equality alone, so it is the same on hashes; a missing id stays missing."""
    hashed = F.when(F.length("user_id") > 0, F.sha2(F.concat(F.lit(check_salt(salt)), F.col("user_id")), 256))
    return parsed.withColumn("user_id", hashed)


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid")


def file_profile(parsed: DataFrame) -> DataFrame:
    """One row: events, valid_events, invalid_events, duplicate_event_ids (repeat
    occurrences among valid rows: rows minus distinct ids), players, sessions."""
    v = F.col("is_valid")
    return parsed.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(v).alias("valid_events"),
        F.count_if(~v).alias("invalid_events"),
        (F.count_if(v) - F.countDistinct(F.when(v, F.col("event_uuid")))).alias("duplicate_event_ids"),
        F.countDistinct(F.when(v, F.col("user_id"))).alias("players"),
        F.countDistinct(F.when(v, F.col("session_id"))).alias("sessions"),
    )


def duplicate_measures(parsed: DataFrame) -> DataFrame:
    """Both duplicate measures over the valid rows: ids seen more than once (the gate's
    measure) and repeat occurrences (rows minus distinct ids, the profile's measure).
    One aggregate per id, combined map side, then a global sum."""
    per_id = valid_rows(parsed).groupBy("event_uuid").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("repeat_occurrences"),
    )


def category_counts(parsed: DataFrame) -> DataFrame:
    """Valid rows per category, ordered by category name."""
    return (
        valid_rows(parsed)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("category")
    )


def error_session_rate(parsed: DataFrame) -> DataFrame:
    """Percent of distinct sessions with at least one error event."""
    v = valid_rows(parsed)
    return v.agg(
        F.countDistinct(F.when(F.col("category") == "error", F.col("session_id"))).alias("error_sessions"),
        F.countDistinct("session_id").alias("sessions"),
    ).withColumn("error_session_rate_percent", percent("error_sessions", "sessions"))


def total_revenue(parsed: DataFrame) -> DataFrame:
    """Business amounts (minor units, null as 0) summed, in USD to two decimals."""
    cents = F.sum(F.when(F.col("category") == "business", F.coalesce(F.col("amount"), F.lit(0))).otherwise(0))
    return valid_rows(parsed).agg(F.coalesce(cents, F.lit(0)).cast("long").alias("revenue_cents")).withColumn(
        "revenue_usd", F.round(F.col("revenue_cents") / F.lit(100.0), 2)
    )


def eligible_retention(parsed: DataFrame) -> DataFrame:
    """D1/D7/D30 retention of eligible players over the whole file.

    A player's cohort day is their earliest signup date. A player is eligible for day
    n when the last event day of the file is at least n days after it, and retained
    when active exactly n days after it.

    Plan: one aggregate per player keeps the earliest signup and the set of active days
    (bounded by the number of days), one per cohort day counts players; the cohort days, a
    row each, then meet the file's last day, which the same rows carry. One scan, and no
    shuffle but these two.
    """
    players = valid_rows(parsed).groupBy("user_id").agg(
        F.min("signup_date").alias("cohort_day"), F.collect_set("event_day").alias("days")
    )
    active = [F.array_contains("days", F.date_add("cohort_day", n)) for n in RETENTION_DAYS]
    cohorts = players.groupBy("cohort_day").agg(
        F.count(F.lit(1)).alias("players"),
        *[F.count_if(a).alias(f"active_d{n}") for n, a in zip(RETENTION_DAYS, active, strict=True)],
        F.max(F.array_max("days")).alias("last_day"),
    )
    all_cohorts = cohorts.agg(F.max("last_day").alias("last_day"), F.collect_list(F.struct(*cohorts.columns)).alias("cohorts"))

    def total(n: int, column: str) -> F.Column:
        eligible = F.filter("cohorts", lambda c: F.datediff(F.col("last_day"), c["cohort_day"]) >= n)
        return F.aggregate(eligible, F.lit(0).cast("long"), lambda t, c: t + c[column])

    out = all_cohorts.select(
        *[
            x
            for n in RETENTION_DAYS
            for x in (total(n, "players").alias(f"eligible_d{n}"), total(n, f"active_d{n}").alias(f"retained_d{n}"))
        ]
    )
    for n in RETENTION_DAYS:
        out = out.withColumn(f"d{n}_retention_percent", percent(f"retained_d{n}", f"eligible_d{n}"))
    return out


def level_counts(parsed: DataFrame) -> DataFrame:
    """Progression events per level (null or empty level: 'unknown'): starts and
    completions, status matched exactly."""
    level = F.coalesce(F.when(F.length("progression_01") > 0, F.col("progression_01")), F.lit(UNKNOWN))
    status = F.col("progression_status")
    return (
        valid_rows(parsed)
        .filter(F.col("category") == "progression")
        .groupBy(level.alias("level"))
        .agg(
            F.count_if(status == "start").alias("starts"),
            F.count_if(status == "complete").alias("completions"),
        )
    )


def hardest_levels(parsed: DataFrame, minimum_starts: int = DEFAULT_MINIMUM_PRIVACY_GROUP) -> DataFrame:
    """The five levels with the lowest (rounded) completion percent among levels with at
    least ``minimum_starts`` starts; ties go to the lower level name."""
    lv = level_counts(parsed).filter(F.col("starts") >= max(minimum_starts, 1))
    lv = lv.withColumn("completion_rate", percent("completions", "starts"))
    return lv.orderBy("completion_rate", "level").limit(TOP_LEVELS)


def sample_player_keys(parsed: DataFrame, salt: str | None) -> DataFrame:
    """Salted hashes of the players of the first five valid rows (by event time, then
    id; repeats allowed) with their position 1..5.

    ``orderBy().limit()`` is a per-task top five merged once; the five rows are then
    numbered by sorting them as one small array (no unpartitioned window). Without a salt
    the ids are hashes already (:func:`hash_players`).
    """
    key = F.col("r.user_id") if salt is None else F.sha2(F.concat(F.lit(check_salt(salt)), F.col("r.user_id")), 256)
    first = valid_rows(parsed).orderBy("event_time", "event_uuid").limit(SAMPLE_KEYS)
    ordered = first.agg(
        F.array_sort(F.collect_list(F.struct("event_time", "event_uuid", "user_id"))).alias("rows")
    )
    return ordered.select(F.posexplode("rows").alias("pos", "r")).select(
        (F.col("pos") + 1).alias("sample_rank"),
        key.alias("player_key"),
    )


def suppressed_privacy_groups(
    parsed: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """(country, day) groups of valid rows, and how many have fewer than the threshold
    of events."""
    groups = valid_rows(parsed).groupBy(
        F.coalesce(F.col("country_code"), F.lit(UNKNOWN)).alias("country_code"), "event_day"
    ).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.count(F.lit(1)).alias("privacy_groups"),
        F.count_if(F.col("n") < minimum_group_size).alias("privacy_groups_suppressed"),
    ).withColumn("privacy_threshold", F.lit(minimum_group_size))


SUMMARY_COLUMNS = [
    "events", "valid_events", "invalid_events", "duplicate_event_ids", "players", "sessions",
    "category_counts", "d1_retention_percent", "d7_retention_percent", "d30_retention_percent",
    "error_session_rate_percent", "revenue_usd", "privacy_groups_suppressed", "privacy_threshold",
    "hardest_levels", "sample_hashed_player_keys",
]


def _totals(parsed: DataFrame) -> DataFrame:
    """One global aggregate for the row-level totals, the distinct counts, revenue and
    the count of each supported category (a fixed list, so no grouping is needed)."""
    v = F.col("is_valid")
    cat = F.col("category")
    return parsed.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(v).alias("valid_events"),
        F.count_if(~v).alias("invalid_events"),
        (F.count_if(v) - F.countDistinct(F.when(v, F.col("event_uuid")))).alias("duplicate_event_ids"),
        F.countDistinct(F.when(v, F.col("user_id"))).alias("players"),
        F.countDistinct(F.when(v, F.col("session_id"))).alias("sessions"),
        F.countDistinct(F.when(v & (cat == "error"), F.col("session_id"))).alias("error_sessions"),
        F.coalesce(
            F.sum(F.when(v & (cat == "business"), F.coalesce(F.col("amount"), F.lit(0)))), F.lit(0)
        ).cast("long").alias("revenue_cents"),
        *[F.count_if(v & (cat == c)).alias(f"n_{c}") for c in sorted(SUPPORTED_CATEGORIES)],
    )


def validation_summary(
    parsed: DataFrame, salt: str | None, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP
) -> DataFrame:
    """All file metrics in one row (nested: category map, level list, key list).

    The five parts (totals, eligible retention, privacy groups, hardest levels,
    sample keys) are one-row aggregates with disjoint columns; they are stacked with
    ``unionByName`` and folded into one row with ``first(ignorenulls)``: one job whose
    scans run side by side, no join. The collected lists hold at most five levels
    and five keys.
    """

    cats = sorted(SUPPORTED_CATEGORIES)
    totals = _totals(parsed).select(
        "events", "valid_events", "invalid_events", "duplicate_event_ids", "players", "sessions",
        F.map_from_entries(
            F.filter(
                F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"n_{c}").alias("v")) for c in cats]),
                lambda e: e["v"] > 0,
            )
        ).alias("category_counts"),
        percent("error_sessions", "sessions").alias("error_session_rate_percent"),
        F.round(F.col("revenue_cents") / F.lit(100.0), 2).alias("revenue_usd"),
    )
    hard = hardest_levels(parsed, minimum_group_size).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("completion_rate", "level", "starts", "completions"))),
            lambda s: F.struct(
                s["level"].alias("level"),
                s["starts"].alias("starts"),
                s["completions"].alias("completions"),
                s["completion_rate"].alias("completion_rate"),
            ),
        ).alias("hardest_levels")
    )
    keys = sample_player_keys(parsed, salt).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("sample_rank", "player_key"))),
            lambda s: s["player_key"],
        ).alias("sample_hashed_player_keys")
    )
    parts = [
        totals,
        eligible_retention(parsed).select(*[f"d{n}_retention_percent" for n in RETENTION_DAYS]),
        suppressed_privacy_groups(parsed, minimum_group_size).select(
            "privacy_groups_suppressed", "privacy_threshold"
        ),
        hard,
        keys,
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in SUMMARY_COLUMNS])
