"""Serving-table shapes, keyed upsert and keyed reads.

Serving tables hold aggregates only (player-level session rows are never published).
Each has a partition key (game + month or day) and clustering columns; writing a row
whose full key exists replaces it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.schema import SERVING_DDL, SERVING_TABLES, TABLE_PARTITION_COLUMN, serving_primary_key

_MONTH = "yyyy-MM"


def serving_shape(rows: DataFrame, table: str) -> DataFrame:
    """The serving table's declared columns from its source table's rows: the day under the
    name that the table gives it and, where the table is partitioned by month, that month."""
    spec = SERVING_TABLES[table]
    day, period = spec["date_column"], spec["partition_key"][1]
    rows = rows.withColumnRenamed(TABLE_PARTITION_COLUMN[spec["source"]], day)
    if period != day:
        rows = rows.withColumn(period, F.date_format(day, _MONTH))
    return rows.select(*[c.split()[0] for c in SERVING_DDL[table].split(", ")])


def serving_engagement(daily_engagement: DataFrame) -> DataFrame:
    return serving_shape(daily_engagement, "daily_engagement_by_game_day")


def serving_retention(cohort_retention: DataFrame) -> DataFrame:
    return serving_shape(cohort_retention, "cohort_retention_by_game_day")


def serving_progression(level_progression: DataFrame) -> DataFrame:
    return serving_shape(level_progression, "level_progression_by_game_day")


def serving_economy(economy_flows: DataFrame) -> DataFrame:
    return serving_shape(economy_flows, "economy_flows_by_game_day")


SERVING_SHAPES = {
    "daily_engagement_by_game_day": ("daily_engagement", serving_engagement),
    "cohort_retention_by_game_day": ("cohort_retention", serving_retention),
    "level_progression_by_game_day": ("level_progression", serving_progression),
    "economy_flows_by_game_day": ("economy_flows", serving_economy),
}


def _key_complete(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def split_null_keys(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete primary key, rows with a null key part)."""
    ok = _key_complete(serving_primary_key(table))
    return rows.filter(ok), rows.filter(~ok)


def upsert_by_key(existing: DataFrame, updates: DataFrame, table: str) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``updates``, plus all ``updates``.

    Updates with a null key part cannot be stored and are left out (count them with
    :func:`split_null_keys`). Keys are unique within each input. Spark picks the
    anti-join strategy at run time (adaptive execution broadcasts ``updates`` only
    when its measured size is under the broadcast threshold, else both sides are
    shuffled on the key).
    """
    keys = serving_primary_key(table)
    good, _ = split_null_keys(updates, table)
    kept = existing.join(good.select(*keys), keys, "left_anti")
    return kept.unionByName(good)


def replace_date_range(existing: DataFrame, updates: DataFrame, table: str, start: str, end: str) -> DataFrame:
    """Publish mode that also deletes: rows of ``existing`` dated in ``[start, end]`` are
    dropped and replaced by ``updates`` (so a group suppressed on rebuild disappears)."""
    d = F.col(SERVING_TABLES[table]["date_column"])
    keep = existing.filter(~d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    good, _ = split_null_keys(updates, table)
    return keep.unionByName(good)


def replace_dates(existing: DataFrame, updates: DataFrame, table: str, dates: Iterable[_dt.date]) -> DataFrame:
    """:func:`replace_date_range` for a list of dates."""
    d = F.col(SERVING_TABLES[table]["date_column"])
    good, _ = split_null_keys(updates, table)
    return existing.filter(~d.isin([F.lit(x) for x in dates])).unionByName(good)


def read_serving(
    rows: DataFrame, table: str, game_id: str, period: str
) -> DataFrame:
    """One partition of a serving table (a game and a month, or a game and a day), in
    clustering order: date newest first where the table says so, other columns
    ascending."""
    spec = SERVING_TABLES[table]
    game_col, period_col = spec["partition_key"]
    if period_col.endswith("_month"):
        period_value = F.lit(period)
    else:
        period_value = F.to_date(F.lit(period))
    out = rows.filter((F.col(game_col) == game_id) & (F.col(period_col) == period_value))
    order = []
    for c in spec["clustering_key"]:
        desc = c == spec["date_column"] and spec["date_descending"]
        order.append(F.col(c).desc() if desc else F.col(c).asc())
    return out.orderBy(*order)
