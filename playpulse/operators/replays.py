"""Event ids that come again after the ingest has forgotten them.

The ingest's dedup remembers ids up to its watermark, the gate looks at one day. An id sent
again later is found by comparing a day's ids with those of earlier days, kept as an index of
two 64-bit hashes an id and day (128 bits, so two ids in one entry are out of the question).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_hashes(events: DataFrame) -> DataFrame:
    """(id_hash, id_check, copies, event_date): the ids of each day; null ids are left out."""
    return (
        events.where("event_uuid IS NOT NULL")
        .groupBy(F.xxhash64("event_uuid").alias("id_hash"), F.xxhash64("event_uuid", F.lit(1)).alias("id_check"), "event_date")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("id_hash", "id_check", "copies", "event_date")
    )


def replays(day_ids: DataFrame, earlier_ids: DataFrame) -> DataFrame:
    """One row: distinct ids of ``day_ids`` that ``earlier_ids`` have (replayed_ids), and their rows (replayed_rows).

    The day's ids are the hashed side of the join, the earlier ones stream past it unsorted.
    With both from a table in buckets by id neither side is shuffled.
    """
    ids = ["id_hash", "id_check"]
    again = earlier_ids.select(*ids).join(day_ids.select(*ids, "copies").hint("shuffle_hash"), ids)
    each = again.groupBy(*ids).agg(F.max("copies").alias("copies"))
    return each.agg(F.count(F.lit(1)).alias("replayed_ids"), F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("replayed_rows"))
