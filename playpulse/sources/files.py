"""Existence and deletion of paths on any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

REQUESTS = 8  # deletions at a time


def _of(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _of(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path and all below it; a missing path is no error."""
    fs, at = _of(spark, path)
    fs.delete(at, True)


def delete_all(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete several paths at a time: a folder's files go one by one."""
    with ThreadPoolExecutor(REQUESTS) as pool:
        list(pool.map(lambda path: delete(spark, path), paths))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, the folders above it too."""
    fs, at = _of(spark, path)
    fs.create(at, True).close()


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything."""
    fs, at = _of(spark, path)
    return fs.exists(at) and len(fs.listStatus(at)) > 0


def listed(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """All files below a folder whose names end so."""
    fs, at = _of(spark, path)
    files, out = fs.listFiles(at, True), []
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(suffix):
            out.append(name)
    return sorted(out)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    fs, at = _of(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory())


def names(spark: SparkSession, path: str) -> set[str]:
    """The names of a folder's data files."""
    return {unquote(p).rpartition("/")[2] for p in spark.read.format("binaryFile").load(path).inputFiles()}


def count(spark: SparkSession, path: str) -> int:
    """The number of files below a folder."""
    fs, at = _of(spark, path)
    return fs.getContentSummary(at).getFileCount()


def size(spark: SparkSession, path: str) -> int:
    """The bytes of the files below a folder."""
    fs, at = _of(spark, path)
    return fs.getContentSummary(at).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _of(spark, path)
    fs.mkdirs(at)


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, at = _of(spark, path)
    if not fs.rename(at, _of(spark, to)[1]):
        raise OSError(f"{path} could not be moved to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    fs, at = _of(spark, f"{path}.part")
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink writes to the folder: readers then list its log, not the folder."""
    return exists(spark, f"{path.rstrip('/')}/_spark_metadata")
