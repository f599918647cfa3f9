"""Size-aware compaction: small files of a day become few files near the advisory size.

File sizes come from a listing of the days' folders, no data is read for it. The small files
of a day are packed first-fit into groups of about ``target_bytes``; a group of one stays as
it is, so large files, days without small files and days compacted before are left alone.

A folder is rewritten through a log in it that readers skip (``_compaction``): merged files are
written there, then one file that lists what replaces what is created, and only then old files
are deleted and new ones moved. A run that ends before the list exists changes nothing; one
that ends after it is finished by the next (:func:`finish`). The row multiset is unchanged.

The driver lists the files of some days at a time (``tables.FILES_AT_ONCE``, one day at least)
and goes through all these steps with them; files of other days are never listed.

A bucketed catalog table is rewritten day by day, those days alone that have a group.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections import defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.config import WRITE_BYTES, CatalogTable, scratch
from playpulse.schema import TABLE_PARTITION_COLUMN
from playpulse.sources.files import (
    count,
    delete,
    exists,
    is_streamed,
    listed,
    make_folder,
    move,
    names,
    read_text,
    write_text,
)
from playpulse.sources.tables import (
    TABLE_SORT_COLUMNS,
    buckets_of,
    conform,
    folders_at_once,
    in_days,
    read_folders,
    location_of,
    read_table_path,
    replace_partitions,
)

TARGET_BYTES = int(WRITE_BYTES[:-1]) << 20
SMALL = 0.5  # of the target: larger files are left alone
FEW = 10  # files that may stay in a folder that is moved aside
LOG = "_compaction"
GROUPS = "day date, bucket string, path string, length long, pack int, files int"


def file_sizes(spark: SparkSession, location: str, partition_column: str, days: Iterable[_dt.date]) -> DataFrame:
    """(day, bucket, path, length) of the data files of some days; bucket is '' where there is none."""
    folders = [f"{location.rstrip('/')}/{partition_column}={d}" for d in sorted(days)]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], "day date, bucket string, path string, length long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", location).load(folders)
    bucket = F.regexp_extract("path", r"_(\d{5})\.c\d+[^/]*$", 1)
    return files.select(F.col(partition_column).cast("date").alias("day"), bucket.alias("bucket"), "path", "length")


def first_fit(target_bytes: int):
    """Packs the files of one day (and bucket), large ones first."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "path"], ascending=[False, True])
        room: list[int] = []
        packs = []
        for length in rows["length"]:
            at = next((i for i, r in enumerate(room) if r >= length), len(room))
            if at == len(room):
                room.append(max(target_bytes, length))
            room[at] -= length
            packs.append(at)
        rows = rows.assign(pack=packs)
        return rows.assign(files=rows.groupby("pack")["path"].transform("size"))

    return pack


def small_files(sizes: DataFrame, target_bytes: int) -> DataFrame:
    return sizes.where(F.col("length") < F.lit(int(SMALL * target_bytes)))


def small_file_groups(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(day, bucket, path, length, pack, files): the small files that are worth merging; one pack becomes one file."""
    return small_files(sizes, target_bytes).groupBy("day", "bucket").applyInPandas(first_fit(target_bytes), GROUPS).where("files > 1")


def compact_small_files(
    spark: SparkSession, at: str, name: str, days: Iterable[_dt.date], target_bytes: int = TARGET_BYTES
) -> dict[_dt.date, int]:
    """Merge the small files of ``days`` of a table in place; returns the files merged per day.

    A folder that a stream writes to is refused: its readers list the stream's log, which
    knows nothing of rewritten files.
    """
    location, part = location_of(spark, at).rstrip("/"), TABLE_PARTITION_COLUMN[name]
    if is_streamed(spark, location):
        raise ValueError(f"{location} is written by a stream; copy its closed days to another table")
    finish(spark, location)
    of_folder = {f"{location}/{part}={d}": d for d in sorted(set(days))}
    merged = {}
    for some in folders_at_once(spark, [f for f in of_folder if exists(spark, f)]):
        merged |= compact_days(spark, at, location, name, [of_folder[f] for f in some], target_bytes)
    return merged


def compact_days(
    spark: SparkSession, at: str, location: str, name: str, days: list[_dt.date], target_bytes: int
) -> dict[_dt.date, int]:
    """Merge the small files of some days, which the driver lists at once."""
    part = TABLE_PARTITION_COLUMN[name]
    with scratch(spark) as s:
        small = small_files(file_sizes(spark, location, part, days), target_bytes)
        small.coalesce(spark.sparkContext.defaultParallelism).write.parquet(found := s.path("small-files"))
        small = spark.read.schema(small.schema).parquet(found)
        if small.groupBy("day", "bucket").count().where("count > 1").isEmpty():
            return {}
        groups = small_file_groups(small, target_bytes)
        groups.write.parquet(path := s.path("groups"))
        groups = spark.read.schema(GROUPS).parquet(path)
        merged = {r["day"]: r["n"] for r in groups.groupBy("day").agg(F.count("*").alias("n")).collect()}
        if not merged:
            return {}
        if isinstance(at, CatalogTable) and buckets_of(spark, at):
            copy = s.path("days")
            rows = read_table_path(spark, at, name).where(in_days(part, merged))
            rows.write.parquet(copy)
            replace_partitions(spark.read.schema(rows.schema).parquet(copy), name, at, merged)
        else:
            merge_files(spark, location, name, groups, merged)
    return merged


def merge_files(spark: SparkSession, location: str, name: str, groups: DataFrame, days: Iterable[_dt.date]) -> None:
    """Write one file per pack and put them in the place of the files that they were made of."""
    part = TABLE_PARTITION_COLUMN[name]
    table = read_folders(spark, location, name, [f"{location}/{part}={d}" for d in days])
    source = F.col("_metadata.file_path").alias("path")
    rows = table.select(*[F.col(c) for c in table.columns], source)
    rows = rows.join(groups.select("path", "pack"), "path").drop("path")
    order = TABLE_SORT_COLUMNS.get(name, [])
    run = f"{location}/{LOG}/{uuid.uuid4().hex[:12]}"
    rows = conform_with(rows, name, "pack").repartition(part, "pack").sortWithinPartitions(part, "pack", *order)
    rows.write.partitionBy(part, "pack").parquet(f"{run}/files")
    moves = []
    for path in listed(spark, f"{run}/files", ".parquet"):
        *_, day, pack, file = path.split("/")  # a task's files of several packs have one name
        moves.append([path, f"{location}/{day}/{pack.replace('=', '-')}-{file}"])
    old = [r[0] for r in groups.select("path").collect()]  # names of the merged files
    write_text(spark, f"{run}.ready", json.dumps({"moves": moves, "old": old}))
    finish(spark, location)


def conform_with(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """The table's columns in their types, and ``more``."""
    shaped = conform(rows, name)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in shaped.dtypes], *more)


def take_out(spark: SparkSession, folder: str, gone: set[str], aside: str) -> None:
    """Delete files of a folder; where nearly all go, at the cost of one deletion.

    The folder is moved aside, files that stay (or came since the listing) are moved back, the
    rest is deleted as a whole. With many files that stay, those to go are deleted one by one.
    A step that a run before has done is not done again.
    """
    old = f"{aside}/{folder.rpartition('/')[2]}"
    if not exists(spark, old):
        if not exists(spark, folder):
            return
        if count(spark, folder) - len(gone) > FEW:
            for name in gone:
                delete(spark, f"{folder}/{name}")
            return
        make_folder(spark, aside)
        move(spark, folder, old)
    make_folder(spark, folder)
    for name in sorted(names(spark, old) - gone):
        move(spark, f"{old}/{name}", f"{folder}/{name}")
    delete(spark, old)


def finish(spark: SparkSession, location: str) -> None:
    """Carry out listed replacements, also those of a run that ended in between, and clear the log.

    Each step may have been done before: what is gone is not deleted or moved again.
    """
    log = f"{location}/{LOG}"
    if not exists(spark, log):
        return
    for ready in listed(spark, log, ".ready"):
        todo = json.loads(read_text(spark, ready))
        of_folder = defaultdict(set)
        for path in todo["old"]:
            folder, _, name = path.rpartition("/")
            of_folder[folder].add(name)
        for folder, gone in of_folder.items():
            take_out(spark, folder, gone, ready.removesuffix(".ready") + "-old")
        for path, to in todo["moves"]:
            if exists(spark, path):
                move(spark, path, to)
    delete(spark, log)
