"""Daily revenue and daily engagement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import suppress_small_groups
from playpulse.schema import DAILY_DIMENSIONS, DAILY_ENGAGEMENT_COLUMNS


def build_daily_revenue(events: DataFrame, currency: str | None = None) -> DataFrame:
    """Business events per day and dimensions: ``sum(coalesce(amount, 0)) / 100.0``.

    All business amounts are taken as USD minor units unless ``currency`` is given,
    in which case only events of that currency count.
    """
    business = events.filter(F.col("category") == "business")
    if currency is not None:
        business = business.filter(F.col("currency") == currency)
    return business.groupBy(*DAILY_DIMENSIONS).agg(
        (F.sum(F.coalesce(F.col("amount"), F.lit(0))) / F.lit(100.0)).alias("revenue_usd")
    )


def histogram_stats(
    rows: DataFrame,
    keys: list[str],
    value: str,
    numerator: int,
    denominator: int,
    alias: str,
    sums: dict[str, F.Column] | None = None,
) -> DataFrame:
    """Per key group: the exact percentile ``numerator / denominator`` of an integer
    column (nearest rank: the smallest value whose running count reaches
    ``ceil(n * p)``, the same value as a discrete quantile and as
    ``percentile_approx`` wherever that is exact), the row count ``_rows``, the count
    of non-null values ``_values``, their sum ``_value_sum``, and each additive column
    of ``sums`` summed over the group.

    Plan: a histogram (one row per key and value, reduced map side, so a hot group is
    spread over its values), then a running count per group ordered by value, then a
    per-group aggregate that reuses the window's partitioning. A group's window holds
    one row per distinct value: bounded when values have a bounded domain (session
    seconds within one day: at most 86,400).
    """
    sums = sums or {}
    present = F.col(value).isNotNull()
    hist = rows.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in sums.items()]
    )
    counted = F.when(present, F.col("_n")).otherwise(F.lit(0))
    group = Window.partitionBy(*keys)
    running = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum(counted).over(running)).withColumn(
        "_total", F.sum(counted).over(group)
    )
    rank = F.floor((F.col("_total") * numerator + (denominator - 1)) / denominator)  # ceil
    return hist.groupBy(*keys).agg(
        F.min(F.when(present & (F.col("_cum") >= rank), F.col(value))).alias(alias),
        F.sum("_n").alias("_rows"),
        F.sum(counted).alias("_values"),
        F.sum(F.col(value) * F.col("_n")).alias("_value_sum"),
        *[F.sum(name).alias(name) for name in sums],
    )


def build_daily_engagement(
    sessions: DataFrame,
    events: DataFrame | None = None,
    minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP,
    null_safe_dimensions: bool = True,
) -> DataFrame:
    """Active players, sessions, mean and p95 session seconds, crash-free rate and
    revenue per (game, day, platform, build, country); groups with fewer than
    ``minimum_group_size`` active players are withheld.

    When ``sessions`` carries ``revenue_cents`` (from :func:`session_facts`) revenue is
    summed from the session rows: the events are not scanned a second time. Otherwise
    revenue is aggregated from ``events`` (business rows).

    ``null_safe_dimensions=False`` reproduces plain-equality join semantics: a group
    with a null platform, build or country gets revenue 0.0.

    Plan: two parts keyed on the dimensions, stacked and grouped once more (grouping
    treats null keys as equal, so no null-safe join is needed):

    - the two distinct counts (Spark expands rows per distinct column; count buffers);
    - a histogram of session seconds (:func:`histogram_stats`) giving the exact p95,
      the mean and, as additive sums, the crash-free rate and revenue: no quantile
      sketch per map task to merge in one reducer for a hot group.
    """
    distinct = sessions.groupBy(*DAILY_DIMENSIONS).agg(
        F.countDistinct("player_key").alias("dau"),
        F.countDistinct("session_id").alias("sessions"),
    )
    sums = {"_errors": F.sum(F.col("has_error").cast("long"))}
    fused_revenue = "revenue_cents" in sessions.columns
    if fused_revenue:
        sums["_cents"] = F.sum("revenue_cents")
    hist = histogram_stats(
        sessions, DAILY_DIMENSIONS, "session_seconds", 95, 100, "p95_session_seconds", sums
    )
    stats = hist.select(
        *DAILY_DIMENSIONS,
        "p95_session_seconds",
        F.try_divide(F.col("_value_sum").cast("double"), F.col("_values")).alias(
            "avg_session_seconds"
        ),
        (F.lit(1.0) - F.col("_errors").cast("double") / F.col("_rows")).alias(
            "crash_free_session_rate"
        ),
        *(
            [(F.coalesce(F.col("_cents"), F.lit(0)) / F.lit(100.0)).alias("revenue_usd")]
            if fused_revenue
            else []
        ),
    )
    parts = [distinct, stats]
    if not fused_revenue:
        if events is None:
            raise ValueError("events are needed when sessions carry no revenue_cents")
        parts.append(build_daily_revenue(events))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    value_cols = [c for c in DAILY_ENGAGEMENT_COLUMNS if c not in DAILY_DIMENSIONS]
    out = stacked.groupBy(*DAILY_DIMENSIONS).agg(*[F.max(c).alias(c) for c in value_cols])
    out = out.filter(F.col("dau").isNotNull())  # groups of the session rows only
    revenue = F.coalesce(F.col("revenue_usd"), F.lit(0.0))
    if not null_safe_dimensions:
        dims_present = reduce(
            lambda a, b: a & b, [F.col(c).isNotNull() for c in DAILY_DIMENSIONS]
        )
        revenue = F.when(dims_present, revenue).otherwise(F.lit(0.0))
    out = out.withColumn("revenue_usd", revenue).select(*DAILY_ENGAGEMENT_COLUMNS)
    return suppress_small_groups(out, "dau", minimum_group_size)
