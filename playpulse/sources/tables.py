"""Date-partitioned Parquet tables: create, write (dynamic or static overwrite), compact.

Partitions are by day (``event_date`` / ``cohort_date``): a daily job then overwrites
exactly the days it recomputed. Before a partitioned write the rows are passed
through a ``rebalance`` hint on the partition column: adaptive execution splits a hot
day over several tasks and merges small ones, so a day holding a third of the rows
does not end up in one task, and small days do not leave a file per task.

A table is a path or a :class:`CatalogTable`, a name in Spark's catalog. Catalog tables are
read with ``spark.table`` and written with ``insertInto``, so the catalog's partitions follow
each write; they are bucketed (``schema.TABLE_BUCKET_COLUMNS``), rows of one bucket and day meet
before the write, and the statistics of the written partitions are brought up to date. A folder
is used either by path or by name: files of the one aren't in the buckets of the other.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playpulse.config import CatalogTable, scratch, scratch_path
from playpulse.schema import BUCKETS, TABLE_BUCKET_COLUMNS, TABLE_DDL, TABLE_PARTITION_COLUMN
from playpulse.sources.files import count, delete, delete_all, exists, folders, is_streamed, make_folder, move, size

WRITE_MODES = ("dynamic", "static", "append")
FILES_AT_ONCE = 20_000  # that the driver lists at a time (one folder at least); it keeps about 1 KB of each
COPY_BYTES = 256 << 20  # a file of a table's copy

# Write options for a new folder of very many files. Below a local path no checksum file is written
# beside each file (Hadoop starts a process for every file that it creates there; other file systems
# aren't touched), and tasks move their files into place, else the driver moves them one by one.
MANY_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
}

# Clustering inside a day's files when a table is compacted: the curated table is
# read by category slices (business, progression, resource) and by player.
TABLE_SORT_COLUMNS = {"game_events": ["category", "game_id", "player_key"]}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty DataFrame with the table's schema."""
    return spark.createDataFrame([], TABLE_DDL[name])


def create_table_sql(name: str, location: str, catalog_table: str | None = None, buckets: int = 0) -> str:
    """``CREATE TABLE IF NOT EXISTS .. USING parquet PARTITIONED BY (day) [CLUSTERED BY ..] LOCATION ..``."""
    part = TABLE_PARTITION_COLUMN[name]
    clustered = ""
    if buckets:
        columns = TABLE_BUCKET_COLUMNS[name]
        order = ", ".join(TABLE_SORT_COLUMNS.get(name, columns))
        clustered = f"CLUSTERED BY ({', '.join(columns)}) SORTED BY ({order}) INTO {buckets} BUCKETS "
    return (
        f"CREATE TABLE IF NOT EXISTS {catalog_table or name} ({TABLE_DDL[name]}) "
        f"USING parquet PARTITIONED BY ({part}) {clustered}LOCATION '{location}'"
    )


def ensure_table(spark: SparkSession, at: str, name: str, location: str, buckets: int = BUCKETS) -> None:
    """Create the catalog table ``at`` over ``location`` if it isn't there, with the partitions found there."""
    if not isinstance(at, CatalogTable) or spark.catalog.tableExists(str(at)):
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {at.database} LOCATION '{location.rpartition('/')[0]}'")
    spark.sql(create_table_sql(name, location, at, buckets))
    if exists(spark, location):
        spark.sql(f"ALTER TABLE {at} RECOVER PARTITIONS")


def location_of(spark: SparkSession, at: str) -> str:
    """The folder of a table."""
    if not isinstance(at, CatalogTable):
        return at
    return next(r[1] for r in spark.sql(f"DESCRIBE FORMATTED {at}").collect() if r[0] == "Location")


def buckets_of(spark: SparkSession, at: CatalogTable) -> tuple[list[str], int] | None:
    """Bucket columns and number of buckets of a catalog table."""
    facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {at}").collect()}
    if "Num Buckets" not in facts:
        return None
    return [c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(",")], int(facts["Num Buckets"])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast the table's columns in DDL order (fails on a missing column)."""
    schema = empty_table(df.sparkSession, name).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_column: str | None,
    mode: str = "dynamic",
    max_records_per_file: int | None = None,
    sort_within: list[str | Column] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write Parquet partitioned by ``partition_column``.

    ``dynamic`` replaces only the partitions present in ``df``; ``static`` replaces the
    whole table (a full rebuild, so partitions absent from the output disappear);
    ``append`` adds files.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if isinstance(path, CatalogTable):
        return insert_into(df, path, partition_column, mode)
    if partition_column:
        df = df.hint("rebalance", partition_column)
    if sort_within:
        # clusters values inside each file: Parquet min/max statistics then let pushed
        # filters on these columns skip row groups
        df = df.sortWithinPartitions(*([partition_column] if partition_column else []), *sort_within)
    w = df.write.format("parquet").options(**(options or {}))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if mode == "append":
        w = w.mode("append")
    else:
        w = w.mode("overwrite").option("partitionOverwriteMode", mode)
    if partition_column:
        w = w.partitionBy(partition_column)
    w.save(path)


def write_table(df: DataFrame, name: str, path: str, mode: str = "dynamic") -> None:
    """Write one of the named tables (columns conformed to its DDL)."""
    write_partitioned(conform(df, name), path, TABLE_PARTITION_COLUMN[name], mode)


def insert_into(df: DataFrame, at: CatalogTable, partition_column: str, mode: str) -> None:
    """Write rows into a catalog table; modes as for :func:`write_partitioned`.

    A name has no write option for the overwrite mode, so the session's setting is made
    dynamic: as ``static`` it would empty the table before a day is written.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = df.select(*spark.table(str(at)).columns)
    bucketed = buckets_of(spark, at)
    if bucketed:  # rows of one day and bucket meet in one task, a hot one in a few
        columns, n = bucketed
        rows = rows.withColumn("bucket_", F.pmod(F.hash(*columns), F.lit(n))).hint("rebalance", partition_column, "bucket_").drop("bucket_")
    else:
        rows = rows.hint("rebalance", partition_column)
    seen = Observation()
    rows = rows.observe(seen, F.collect_set(partition_column).alias("parts"))
    rows.write.mode("append" if mode == "append" else "overwrite").insertInto(str(at))
    written = observed_days(seen, "parts")
    if mode == "static":
        drop_partitions(spark, at, partition_column, partitions_of(spark, at) - written)
    for value in sorted(written):
        spark.sql(f"ANALYZE TABLE {at} PARTITION ({partition_column} = '{value}') COMPUTE STATISTICS")


def observed_days(seen: Observation, name: str) -> set[_dt.date]:
    """The dates that ``collect_set`` observed in a write that has ended.

    Of an empty input Spark leaves out the whole plan, the observation with it, which then has
    no row to give.
    """
    try:
        return set(seen.get[name])
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return set()


def partitions_of(spark: SparkSession, at: CatalogTable) -> set[_dt.date]:
    """The days that the catalog lists for a table."""
    names = (r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {at}").collect())
    return {_dt.date.fromisoformat(x) for x in names}


def drop_partitions(spark: SparkSession, at: str, partition_column: str, values: Iterable[_dt.date]) -> None:
    """Drop partitions and their files; those that aren't there are no error."""
    location = location_of(spark, at).rstrip("/")
    for value in values:
        if isinstance(at, CatalogTable):
            spark.sql(f"ALTER TABLE {at} DROP IF EXISTS PARTITION ({partition_column} = '{value}')")
        delete(spark, f"{location}/{partition_column}={value}")


def days_between(start: str, end: str) -> list[_dt.date]:
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    return [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]


def in_days(column: str, days: Iterable[_dt.date]) -> Column:
    """Whether a date column is one of ``days``; a filter that prunes partitions."""
    return F.col(column).isin([F.lit(d) for d in days])


def replace_partitions(
    df: DataFrame, name: str, at: str, wanted: Iterable[_dt.date], drop_missing: bool = True, sort_within: list[str] | None = None
) -> set[_dt.date]:
    """Replace the partitions ``wanted`` of a table by ``df``, which must not read the table itself.

    A row of any other partition fails the write before anything is replaced. Unlike a dynamic
    overwrite alone, a wanted partition without a row in ``df`` loses its old rows (a group
    that fell below the privacy threshold, say), unless ``drop_missing`` is off. Returns the
    partitions that have rows now.
    """
    part, wanted = TABLE_PARTITION_COLUMN[name], set(wanted)
    other = F.raise_error(F.concat(F.lit(f"{name}: a row of the unwanted partition "), F.coalesce(F.col(part).cast("string"), F.lit("null"))))
    seen = Observation()
    rows = conform(df, name).withColumn(part, F.when(in_days(part, wanted), F.col(part)).otherwise(other.cast("date")))
    rows = rows.observe(seen, F.collect_set(part).alias("parts"))
    write_partitioned(rows, at, part, "dynamic", sort_within=sort_within or TABLE_SORT_COLUMNS.get(name))
    written = observed_days(seen, "parts")
    if drop_missing:
        drop_partitions(df.sparkSession, at, part, wanted - written)
    return written


def replace_days(
    df: DataFrame, name: str, path: str, start: str, end: str, sort_within: list[str] | None = None, drop_missing: bool = True
) -> set[_dt.date]:
    """:func:`replace_partitions` of the days ``start`` .. ``end``."""
    return replace_partitions(df, name, path, days_between(start, end), drop_missing, sort_within)


def read_table_path(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Read a partitioned table; filters on the partition column prune directories.

    With a table ``name`` the declared schema is used (no inference, and a table whose
    rows were all suppressed, so without data files, still reads as empty).
    """
    if isinstance(path, CatalogTable):
        return spark.table(str(path)).select(*empty_table(spark, name).columns if name else "*")
    if name is None:
        return spark.read.parquet(path)
    return spark.read.schema(empty_table(spark, name).schema).parquet(path)


def folders_at_once(spark: SparkSession, paths: Iterable[str]) -> list[list[str]]:
    """Folders, cut where together they would hold more than ``FILES_AT_ONCE`` files."""
    parts, total = [], 0
    for path in paths:
        files = count(spark, path)
        if not parts or total + files > FILES_AT_ONCE:
            parts.append([])
            total = 0
        parts[-1].append(path)
        total += files
    return parts


def read_folders(spark: SparkSession, location: str, name: str, paths: Iterable[str]) -> DataFrame:
    """Some partitions of a table by their folders; no other file is listed."""
    return spark.read.schema(empty_table(spark, name).schema).option("basePath", location).parquet(*paths)


def read_many_files(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A partitioned table of any number of files.

    Spark keeps a list of all files that it is to read in the driver. A table of more than
    ``FILES_AT_ONCE`` files is therefore read some partitions at a time and copied to a scratch
    folder of few files, and these are read.
    """
    location, part = path.rstrip("/"), TABLE_PARTITION_COLUMN[name]
    parts = folders_at_once(spark, [f"{location}/{f}" for f in folders(spark, location) if f.startswith(f"{part}=")])
    if len(parts) < 2:
        return read_table_path(spark, location, name)
    copy = scratch_path(spark, "table-copy")
    for some in parts:
        files = max(spark.sparkContext.defaultParallelism, sum(size(spark, f) for f in some) // COPY_BYTES)
        read_folders(spark, location, name, some).coalesce(files).write.mode("append").parquet(copy)
    return spark.read.schema(read_folders(spark, location, name, parts[-1]).schema).parquet(copy)


def compact(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    partition_column: str | None,
    max_records_per_file: int | None = None,
    table: str | None = None,
) -> DataFrame:
    """Rewrite a table's small files into fewer, larger ones at ``target_path``.

    Never writes over the path it reads: the caller switches readers to the new path
    afterwards. The row multiset is unchanged. Returns the compacted table.
    """
    if source_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("compaction must write to a new location")
    df = read_table_path(spark, source_path, table)
    write_partitioned(df, target_path, partition_column, "static", max_records_per_file)
    return read_table_path(spark, target_path, table)


def compact_partitions(
    spark: SparkSession,
    table_path: str,
    partition_column: str,
    values: list[str],
    table: str | None = None,
    max_records_per_file: int | None = None,
    sort_within: list[str] | None = None,
) -> None:
    """Rewrite only the given partitions of a table in place (a daily job's days).

    The partitions' rows are written once, to a new folder of the table that readers skip; then
    each partition's folder is moved aside and the new one into its place, and what was moved
    aside is deleted. The rest of the table is not read or rewritten, and the job never reads
    the path it overwrites. A partition without rows stays as it is. The row multiset is
    unchanged. A catalog table gets its rows back from a copy below the shared checkpoint
    folder, with dynamic partition overwrite.

    A folder that a stream writes to is refused: its readers list the stream's log, which
    knows nothing of rewritten files, and rows may arrive meanwhile.
    """
    location = location_of(spark, table_path).rstrip("/")
    if is_streamed(spark, location):
        raise ValueError(f"{table_path} is written by a stream; copy its closed days to another table")
    wanted = F.col(partition_column).isin([F.lit(v).cast("date") for v in values])
    source = read_table_path(spark, table_path, table).filter(wanted)
    if sort_within is None and table is not None:
        sort_within = TABLE_SORT_COLUMNS.get(table)

    def write(rows: DataFrame, to: str, mode: str) -> None:
        rows = rows if table is None else conform(rows, table)
        write_partitioned(rows, to, partition_column, mode, max_records_per_file, sort_within)

    if isinstance(table_path, CatalogTable):
        with scratch(spark) as s:
            staged = s.path("compact-stage")
            source.write.parquet(staged)
            write(spark.read.schema(source.schema).parquet(staged), table_path, "dynamic")
        return
    run = f"{location}/_compact-{uuid.uuid4().hex[:12]}"
    try:
        write(source, f"{run}/new", "static")
    except BaseException:
        delete(spark, run)
        raise
    old = swap_folders(spark, f"{run}/new", location, f"{run}/old")
    delete_all(spark, old)
    delete(spark, run)
    spark.catalog.refreshByPath(location)


def swap_folders(spark: SparkSession, new: str, location: str, aside: str) -> list[str]:
    """Move the folders of ``new`` to ``location``, those of their names there to ``aside``; returns where these are now.

    If one can't be moved in, the one it should replace is moved back.
    """
    make_folder(spark, aside)
    replaced = []
    for name in folders(spark, new):
        at, old = f"{location}/{name}", f"{aside}/{name}"
        there = exists(spark, at)
        if there:
            move(spark, at, old)
        try:
            move(spark, f"{new}/{name}", at)
        except BaseException:
            if there:
                move(spark, old, at)
            raise
        if there:
            replaced.append(old)
    return replaced


def file_count(spark: SparkSession, path: str) -> int:
    """Number of data files of a table (one row per file: the file list itself)."""
    return spark.read.parquet(path).select(F.input_file_name()).distinct().count()
