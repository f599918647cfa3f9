"""Exact distinct counts that add up: a bitmap of dense ids per group, OR-ed for coarser groups.

Distinct counts per platform don't sum to the count per build, so a coarser view would have to
read the sessions again. Players and sessions get dense ids once; a group's ids are one bitmap
for each block of 32,768 ids, of 4 KB. Coarser groups and longer periods are the OR of these
rows, exactly, and only the bitmaps are read. No group's ids meet in one row or task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.config import DEFAULT_MINIMUM_PRIVACY_GROUP
from playpulse.functions.privacy import suppress_small_groups

ID_BUCKETS = 4096  # tasks that can number values


def dense_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, id) of the distinct non-null values: ``known`` ids stay, new values get the next ones.

    Values are numbered within buckets of their hash, by the counts of the buckets before.
    """
    new = values.where(F.col(column).isNotNull()).select(column).distinct()
    last = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known, column, "left_anti")
        last = F.lit(known.agg(F.max("id")).first()[0] or 0)
    new = new.withColumn("bucket", F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over ID_BUCKETS rows
    counts = new.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("bucket").orderBy(column))
    made = new.withColumn("own", own).join(counts, "bucket").select(column, (F.col("own") + F.col("first") + last).alias("id"))
    return made if known is None else known.select(column, "id").unionByName(made)


def distinct_bitmaps(rows: DataFrame, by: list[str], ids: Mapping[str, DataFrame]) -> DataFrame:
    """(by, kind, block, bits): per group and column of ``ids`` (column: its dense ids) the ids that occur."""
    out = None
    for column, known in ids.items():
        found = (
            rows.select(*by, column).join(known.select(column, "id"), column)
            .groupBy(*by, F.lit(column).alias("kind"), F.bitmap_bucket_number("id").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
        )
        out = found if out is None else out.unionByName(found)
    return out


def distinct_counts(bitmaps: DataFrame, by: list, kinds: list[str]) -> DataFrame:
    """(by, one count per kind) of groups as coarse as wanted; null group values count as a group."""
    merged = bitmaps.groupBy(*by, "kind", "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    names = [c for c in merged.columns if c not in ("kind", "block", "n")]
    return merged.groupBy(*names).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("long").alias(k) for k in kinds])


def session_sums(sessions: DataFrame, by: list[str]) -> DataFrame:
    """What of the sessions adds up as it is: (by, session_rows, session_seconds, error_rows)."""
    return sessions.groupBy(*by).agg(
        F.count("session_seconds").alias("session_rows"), F.sum("session_seconds").alias("session_seconds"), F.sum("has_error").cast("long").alias("error_rows")
    )


def release_view(bitmaps: DataFrame, sums: DataFrame, minimum_group_size: int = DEFAULT_MINIMUM_PRIVACY_GROUP) -> DataFrame:
    """:func:`playpulse.operators.extras.build_release_view` from stored bitmaps and sums.

    Both sides are stacked and grouped, so null builds meet as well.
    """
    by = ["game_id", "event_date", "build"]
    counts = distinct_counts(bitmaps, by, ["player_key", "session_id"]).withColumnsRenamed({"player_key": "dau", "session_id": "sessions"})
    added = sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("session_rows", "session_seconds", "error_rows")])
    both = counts.unionByName(added, allowMissingColumns=True).groupBy(*by).agg(
        F.max("dau").alias("dau"), F.max("sessions").alias("sessions"),
        (F.max("session_seconds") / F.max("session_rows")).alias("avg_session_seconds"),
        (F.lit(1.0) - F.max("error_rows") / F.max("session_rows")).alias("crash_free_session_rate"),
    )
    return suppress_small_groups(both, "dau", minimum_group_size)
