"""JSON-lines event files (plain or compressed, chosen by file extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json_lines(spark: SparkSession, path: str | list[str], value_column: str = "value") -> DataFrame:
    """One row per line, the raw text in ``value_column``.

    Reading as text (instead of ``spark.read.json``) keeps malformed lines as rows, so
    they can be counted instead of failing the scan. Compression follows the file
    extension (``.gz``, ``.bz2``, ``.zst`` ...). A gzip file is one split: write many
    files (or a splittable codec) for large inputs.
    """
    df = spark.read.text(path)
    return df.withColumnRenamed("value", value_column) if value_column != "value" else df


def write_json_lines(
    lines: DataFrame, path: str, compression: str | None = None, mode: str = "error"
) -> None:
    """Write a single string column as text files, one JSON object per line."""
    w = lines.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
