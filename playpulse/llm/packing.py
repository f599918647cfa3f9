"""Harmonic packing of token sequences.

Each document's ids, closed by an end id, are cut into whole sequences of ``capacity`` and,
of the rest, pieces of capacity/2, /4, ... down to ``finest``; what remains is the tail. A
piece of length L belongs to the reciprocal-capacity class k = capacity // L: any k pieces of
class k fit one bin, so bins are filled by counting alone. Exact fractions fill their bins
without padding; a tail class k wastes less than 1/(k+1).

Workers number the pieces of a class per bucket; the counts of all (class, bucket) pairs turn
these numbers into a class-wide rank r, bin r // k. There are less than twice the root of the
capacity classes. No piece waits for another and no class is gathered anywhere. The last pieces
of each class that don't fill a bin, fewer than the sum of all k (about 11,000 at a capacity of
2,048, at any size of the input), are packed together first-fit by falling length.

Without ``weights`` the pieces of a class are numbered by a hash. With them documents take
their positions in the mix (``mixing.placed``) and the pieces of a class are numbered by
position, within ranges of about equally many pieces, so bins fill in the order of the mix;
``sequence_position``, the smallest position in a sequence, orders the sequences (those of one
document by ``sequence_id``).

Null texts count as empty: their only id is the end id. Null and repeated ids and repeated
rows are packed row by row; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import id_and_text, shared_setting, ship_code, slices, staged
from playpulse.llm.mixing import BLOCK, placed
from playpulse.llm.tokens import splits_safely, token_bytes

CAPACITY = 2048
FINEST = 128
END_ID = 1
CLASS_IDS = 1 << 40  # sequence ids of class k start at k times this

PIECES = "doc_tokens long, pieces array<struct<start:long,length:long,ids_crc32:long,k:int>>"


def cut_lengths(n: int, capacity: int, finest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole sequences, exact fractions, the tail."""
    out, size = [capacity] * (n // capacity), capacity // 2
    n %= capacity
    while size >= finest:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return [*out, n] if n else out


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, finest: int, end_id: int, by_word: bool) -> DataFrame:
    """``docs`` with the pieces of each text in its place."""
    end = np.asarray([end_id], "<u4").tobytes()
    kept = [c for c in docs.columns if c != "text"]

    def cut(batches):
        for part in slices(batches, "text"):
            rows, begins, tokens = [], [0], []
            for ids in token_bytes(part.column(part.schema.names.index("text")), tokenizer, by_word):
                ids, start, n = ids + end, 0, len(ids) // 4 + 1
                for length in cut_lengths(n, capacity, finest):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((start, length, crc, capacity // length))
                    start += length
                begins.append(len(rows))
                tokens.append(n)
            types = [pa.int64()] * 3 + [pa.int32()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            pieces = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.StructArray.from_arrays(cols, ["start", "length", "ids_crc32", "k"]))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.names.index(c)) for c in kept], pa.array(tokens, pa.int64()), pieces], [*kept, "doc_tokens", "pieces"]
            )

    return docs.mapInArrow(cut, f"{', '.join(f'{c} {t}' for c, t in docs.dtypes if c in kept)}, {PIECES}")


def in_ranges(pieces: DataFrame, ranges: int) -> DataFrame:
    """``pieces`` with the number b of their range of positions; each range holds about equally many."""
    cuts = [i / ranges for i in range(1, ranges)]
    ends = pieces.agg(F.percentile_approx("position", cuts, 100 * ranges)).first()[0] or []  # one less than ranges
    ends_at = F.array(*map(F.lit, ends)).cast("array<long>")
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(ranges.bit_length()))])
    step = lambda at, half: at + F.when(F.get(ends_at, at + half - 1) < F.col("position"), half).otherwise(0)
    return pieces.withColumn("b", F.aggregate(halves, F.lit(0), step))


def first_fit(capacity: int):
    """Packs the few pieces that fill no bin of their class; a group of bounded size."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "k", "r"], ascending=[False, True, True], kind="stable")
        used: list[int] = []
        bins, offsets = [], []
        for length in rows["length"]:
            at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            bins.append(at)
            offsets.append(used[at])
            used[at] += int(length)
        out = rows.drop(columns=["k", "r"]).assign(sequence_id=bins, offset=offsets)
        if "position" in out:
            out["sequence_position"] = out.groupby("sequence_id")["position"].transform("min")
            out = out.drop(columns="position")
        return out

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    finest: int = FINEST,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_word: bool | None = None,
    weights: dict[str, int] | None = None,
    block: int = BLOCK,
    source_col: str = "source",
) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    With ``weights`` the sequences follow the mix of the sources, and sequence_position is the last column.
    """
    ship_code(docs.sparkSession)
    by_word = splits_safely(tokenizer) if by_word is None else by_word
    buckets = max(32, shared_setting(docs.sparkSession, "spark.sql.shuffle.partitions", 200))
    source = [F.col(f"`{source_col}`").cast("string").alias("source")] if weights else []
    texts = id_and_text(docs, id_col, text_col, *source)
    cut = staged(cut_pieces(texts, tokenizer, capacity, finest, end_id, by_word), "pieces")
    if weights:
        rows, n = placed(cut, weights, block, "doc_id", "source")
        pieces = staged(rows.select("doc_id", "doc_tokens", F.col(n["position"]).alias("position"), F.inline("pieces")), "mixed-pieces")
        pieces, order = in_ranges(pieces, buckets), ["position"]
    else:
        pieces, order = cut.select("doc_id", "doc_tokens", F.inline("pieces")), []
        pieces = pieces.withColumn("b", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        pieces.groupBy("k", "b").agg(F.count("*").alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("all", F.sum("n").over(Window.partitionBy("k")))
        .drop("n")
    )
    own = Window.partitionBy("k", "b").orderBy(*order, "doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("own", F.row_number().over(own) - 1)
        .join(counts, ["k", "b"])
        .withColumn("r", F.col("own") + F.col("first"))
        .withColumn("bin", F.floor(F.col("r") / F.col("k")))
        .withColumn("full", F.col("r") < F.col("all") - F.col("all") % F.col("k"))
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    in_bin = Window.partitionBy("k", "bin").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.where("full").select(
        *columns,
        (F.col("k") * F.lit(CLASS_IDS) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(in_bin), F.lit(0)).alias("offset"),
        *[F.min(c).over(Window.partitionBy("k", "bin")).alias(f"sequence_{c}") for c in order],
    )
    rest = (
        ranked.where("not full").select(*columns, *order, "k", "r")
        .groupBy(F.lit(0).alias("one"))
        .applyInPandas(
            lambda rows: first_fit(capacity)(rows.drop(columns="one", errors="ignore")),
            ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset", *[f"sequence_{c}" for c in order]]),
        )
    )
    return filled.unionByName(rest)
