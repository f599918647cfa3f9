"""Helpers shared by the operators: scratch tables, free column names, byte-bounded batches, word runs."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.config import scratch_path
from playpulse.sources.files import delete

SLICE_BYTES = 8 << 20  # text handled at once inside a task


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once an application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="playpulse-code-")) / "playpulse_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


_scopes: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end, but those that are kept; also after an error."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor can reach, so a lost executor costs a
    reread and not a recomputation. Within ``temporary`` the table goes with the innermost
    block, with ``keep`` with the one around it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    around = _scopes[: len(_scopes) - keep]
    if around:
        around[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares names without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id long, text string not null) and ``more``; all further columns are left out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"), *more)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each slice hold about ``limit`` bytes (one text at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts as one dictionary array, and the first word of each text.

    The second array has one entry more than there are texts.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    offsets = offsets - offsets[0]
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.concatenate(([0], np.cumsum(full)))
        words, offsets = words.filter(pa.array(full)), before[offsets]
    return words.dictionary_encode(), offsets


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer that spreads every input bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: pa.DictionaryArray) -> np.ndarray:
    """A 64-bit hash for each word."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    unique = words.dictionary.to_numpy(zero_copy_only=False).astype(object)
    return mixed(pd.util.hash_array(unique, categorize=False))[words.indices.to_numpy()]


def shared_setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))
