"""Serving-store writer and reader.

A keyed store (any DataFrame source whose append is an upsert by primary key, such
as a wide-column store connector) gets a plain append. On Parquet the same effect is
produced with the merges of :mod:`playpulse.operators.serving`, either

- in place, partition by partition (:func:`publish_partitions`, the default): the
  table is partitioned by its period column (month or day), only the partitions the
  update touches are read, merged and replaced; or
- as a new version directory (:func:`publish_parquet`): the previous version is read
  whole, never overwritten.

``replace`` says what a publication takes away: nothing (None, rows are upserted by key),
the days of a set, so that groups which the rebuilt days no longer have disappear, or
everything (``"all"``). A keyed store takes rows by upsert alone. With
``JobConfig.serving_delete_options`` its published keys are kept in a Parquet table; keys that
a publication takes away are written once more, without values, with these options (a time to
live of a second, say). Without them such rows must expire by the store's own means.

Parquet rows lie in the order in which they are read (game, newest day first), and files carry
a Bloom filter on the game, so a read of one game opens the row groups that hold it.

Rows with a null key part cannot be addressed and reach no store.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.config import JobConfig, scratch
from playpulse.operators.serving import replace_dates, split_null_keys, upsert_by_key
from playpulse.schema import SERVING_DDL, SERVING_TABLES, serving_primary_key
from playpulse.sources.files import delete, exists
from playpulse.sources.tables import write_partitioned

ALL = "all"
GAMES_PER_ROW_GROUP = 10_000  # that a Bloom filter is sized for
Replace = Collection[_dt.date] | str | None


def write_keyed_store(df: DataFrame, table: str, fmt: str, options: dict[str, str]) -> None:
    """Append to a keyed store: format and options (keyspace, host ...) from config."""
    df.write.format(fmt).mode("append").options(table=table, **options).save()


def stored_order(table: str) -> list[Column]:
    """The order of a serving table's rows within a period: by game, then as a read returns them."""
    spec = SERVING_TABLES[table]
    newest = lambda c: c == spec["date_column"] and spec["date_descending"]
    rest = [c for c in spec["clustering_key"] if c != period_column(table)]
    return [F.col(spec["partition_key"][0]), *[F.desc(c) if newest(c) else F.col(c) for c in rest]]


def bloom_options(table: str) -> dict[str, str]:
    """Writer options for a Bloom filter on the column that reads ask for.

    Parquet leaves it out of row groups whose dictionary has all values, which tells as much.
    """
    column = SERVING_TABLES[table]["partition_key"][0]
    return {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(GAMES_PER_ROW_GROUP)}


def merged_rows(existing: DataFrame | None, rows: DataFrame, table: str, replace: Replace) -> DataFrame:
    if existing is None or replace == ALL:
        return rows
    if replace is None:
        return upsert_by_key(existing, rows, table)
    return replace_dates(existing, rows, table, replace)


def publish_parquet(
    spark: SparkSession, rows: DataFrame, table: str, current_path: str | None, new_path: str, replace: Replace = None
) -> DataFrame:
    """Merge ``rows`` into the Parquet version at ``current_path``, written to ``new_path``;
    returns the new version. A version that is named but doesn't exist is an error: taken
    as empty, it would publish a version without any history."""
    rows, _ = split_null_keys(rows, table)
    if current_path and not exists(spark, current_path):
        raise FileNotFoundError(f"no previous version at {current_path}")
    existing = read_serving_table(spark, current_path, table) if current_path else None
    merged = merged_rows(existing, rows, table, replace)
    merged.sortWithinPartitions(period_column(table), *stored_order(table)).write.mode("overwrite").options(**bloom_options(table)).parquet(new_path)
    return read_serving_table(spark, new_path, table)


def period_column(table: str) -> str:
    """The period part of a serving table's partition key (month or day)."""
    return SERVING_TABLES[table]["partition_key"][1]


def periods_of(table: str, days: Collection[_dt.date]) -> set:
    """The values of the table's period column that hold ``days``."""
    if period_column(table) == SERVING_TABLES[table]["date_column"]:
        return set(days)
    return {d.strftime("%Y-%m") for d in days}


def publish_partitions(
    spark: SparkSession, rows: DataFrame, table: str, path: str, replace: Replace = None
) -> DataFrame:
    """Merge ``rows`` into the Parquet table at ``path``, touching only the periods
    (months or days) that occur in ``rows`` or in the replaced range.

    The rows are staged in the shared folder and the list of their periods is collected
    (bounded: the periods of one publish); the existing rows of those partitions are read by
    partition pruning, merged by primary key, staged and written back with dynamic partition
    overwrite, sorted by primary key so that a read of one game skips row groups. Periods
    left without a row are deleted. Other partitions are neither read nor rewritten, so a
    daily publish costs the size of its periods, not of the history.
    """
    period = period_column(table)
    order, bloom = stored_order(table), bloom_options(table)
    good, _ = split_null_keys(rows, table)
    with scratch(spark) as s:
        update, merged = s.path(f"serving-update-{table}"), s.path(f"serving-{table}")
        good.write.parquet(update)
        good = read_serving_table(spark, update, table)
        present = exists(spark, path)
        if replace == ALL or not present:
            write_partitioned(good, path, period, "static", sort_within=order, options=bloom)
            return read_serving_table(spark, path, table)
        periods = {r[0] for r in good.select(period).distinct().collect()}
        if replace is not None:
            periods |= periods_of(table, replace)
        touched = read_serving_table(spark, path, table).filter(F.col(period).isin(list(periods)))
        merged_rows(touched, good, table, replace).write.parquet(merged)
        out = read_serving_table(spark, merged, table)
        left = {r[0] for r in out.select(period).distinct().collect()}
        write_partitioned(out, path, period, "dynamic", sort_within=order, options=bloom)
    for p in periods - left:
        delete(spark, f"{path.rstrip('/')}/{period}={p}")
    return read_serving_table(spark, path, table)


def read_serving_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A Parquet serving table with its declared schema (empty tables read as empty)."""
    return spark.read.schema(SERVING_DDL[table]).parquet(path)


def publish(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    config: JobConfig,
    current_path: str | None = None,
    new_path: str | None = None,
    replace: Replace = None,
) -> DataFrame | None:
    """Write one serving table by the configured format: a keyed store gets an append;
    Parquet gets an in-place partition merge at the configured serving path, or a new
    version at ``new_path`` when one is given."""
    rows, _ = split_null_keys(rows, table)
    if config.serving_format == "parquet":
        if new_path is None:
            return publish_partitions(spark, rows, table, config.serving_path(table), replace)
        return publish_parquet(spark, rows, table, current_path, new_path, replace)
    publish_keyed(spark, rows, table, config, replace)
    return None


def publish_keyed(spark: SparkSession, rows: DataFrame, table: str, config: JobConfig, replace: Replace = None) -> None:
    """Upsert rows into a keyed store and delete what ``replace`` takes away.

    The table of published keys learns new keys before they are sent and forgets old ones after
    their deletion, so a run that ends in between is made good by the next.
    """
    options = dict(config.serving_options)
    if config.serving_delete_options is None:
        return write_keyed_store(rows, table, config.serving_format, options)
    known_path, key = config.serving_path(f"{table}_keys"), serving_primary_key(table)
    with scratch(spark) as s:
        update, gone_path = s.path(f"keyed-{table}"), s.path(f"keyed-gone-{table}")
        rows.write.parquet(update)
        rows = read_serving_table(spark, update, table)
        keys = rows.select(*key)
        publish_partitions(spark, keys, table, known_path)
        write_keyed_store(rows, table, config.serving_format, options)
        if replace is None:
            return
        known = read_serving_table(spark, known_path, table)
        if replace != ALL:
            known = known.where(F.col(SERVING_TABLES[table]["date_column"]).isin([F.lit(d) for d in replace]))
        known.join(keys, key, "left_anti").select(*rows.columns).write.parquet(gone_path)
        gone = read_serving_table(spark, gone_path, table)
        if gone.limit(1).count():
            write_keyed_store(gone, table, config.serving_format, options | dict(config.serving_delete_options))
        publish_partitions(spark, keys, table, known_path, replace)
