"""Best-fit decreasing packing of whole documents into as few sequences as possible.

Each document's ids, closed by an end id, stay in one piece; only a document longer than
``capacity`` is cut, into pieces of ``capacity`` and a last, shorter one. Pieces go into
sequences by falling length, each into the open sequence with the least room that still
takes it, a new one where none does. That sequence is found in logarithmic time by a segment
tree over the remaining capacities (leaf r: the open sequences with room r).

Pieces of one length are interchangeable, so the packing is worked out on the number of
pieces of each length: at most ``capacity`` rows, whatever the input's size. It is the exact
best-fit decreasing packing of all pieces together, not one per worker: of c pieces of length
L, each sequence of the tightest room r takes r // L of them before the next is touched, so
whole runs of equal sequences are filled at once. The outcome is a table of runs: the pieces
of length L ranked from a to a + m go k at a time into the sequences from s on, at offset o.

Every map task numbers its own pieces of each length; the counts of (length, task) turn these
numbers into ranks over all tasks, and a piece finds its run by them. No length, however
common, is gathered or sorted anywhere.

Null texts count as empty: their only id is the end id. Null and repeated ids and repeated
rows are packed row by row; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict, deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import id_and_text, ship_code, slices, staged
from playpulse.llm.tokens import splits_safely, token_bytes

CAPACITY = 4096
END_ID = 1

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, own long"
RUN = ["length", "rank", "many", "per", "first_sequence", "at"]


class RoomTree:
    """A segment tree over rooms 0 .. ``capacity``: which of them open sequences have, and those sequences.

    Equal sequences are kept as ranges (first, number) of their consecutive numbers.
    """

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.width)  # whether anything below the node is open
        self.ranges: dict[int, deque[tuple[int, int]]] = defaultdict(deque)

    def _mark(self, room: int, open_: bool) -> None:
        node = room + self.width
        self.some[node] = open_
        while node > 1:
            node >>= 1
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def add(self, room: int, first: int, number: int, front: bool = False) -> None:
        if number and room:
            ranges = self.ranges[room]
            (ranges.appendleft if front else ranges.append)((first, number))
            if len(ranges) == 1:
                self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        out = self.ranges[room].popleft()
        if not self.ranges[room]:
            self._mark(room, False)
        return out

    def tightest(self, length: int) -> int | None:
        """The least room of an open sequence that takes ``length``."""
        node = length + self.width
        if self.some[node]:
            return length
        while node > 1:  # up to the first node with something open to the right, then down to its left end
            if not node & 1 and self.some[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.some[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank, many, per, first sequence, offset) of best-fit decreasing over ``counts`` of lengths."""
    tree, runs, opened = RoomTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, number = capacity, -(-left // (capacity // length))
                first, opened = opened, opened + number
            else:
                first, number = tree.take(room)
            per = room // length
            full = min(number, left // per)
            if full:
                runs.append((length, rank, full * per, per, first, capacity - room))
                tree.add(room - per * length, first, full)
                rank, left, first, number = rank + full * per, left - full * per, first + full, number - full
            if number and left:  # fewer are left than one sequence takes
                runs.append((length, rank, left, left, first, capacity - room))
                tree.add(room - left * length, first, 1)
                left, first, number = 0, first + 1, number - 1
            tree.add(room, first, number, front=True)
    return runs


def cut_pieces(texts: DataFrame, tokenizer: str, capacity: int, end_id: int, by_word: bool) -> DataFrame:
    """The pieces of all documents, each with its number among the task's pieces of its length."""
    end = np.asarray([end_id], "<u4").tobytes()
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
    names = [c.split()[0] for c in PIECE.split(", ")]

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for part in slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), token_bytes(part.column(1), tokenizer, by_word), strict=True):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(cut, PIECE)


def best_fit(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_word: bool | None = None,
) -> DataFrame:
    """A row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``sequence_id`` counts the sequences from 0 without a gap.
    """
    ship_code(docs.sparkSession)
    by_word = splits_safely(tokenizer) if by_word is None else by_word
    pieces = staged(cut_pieces(id_and_text(docs, id_col, text_col), tokenizer, capacity, end_id, by_word), "whole-pieces")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:  # at most ``capacity`` rows
        return pd.DataFrame(plan(dict(zip(rows["length"].tolist(), rows["n"].tolist(), strict=True)), capacity), columns=RUN)

    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    runs = lengths.groupBy(F.lit(0).alias("one")).applyInPandas(packed, ", ".join(f"{c} long" for c in RUN))
    last = F.least(F.col("rank") + F.col("many"), F.col("first") + F.col("n"))
    spans = (
        ranked.join(runs, "length").where((F.col("rank") < F.col("first") + F.col("n")) & (F.col("first") < F.col("rank") + F.col("many")))
        .select(
            "length", "task", "per", "first_sequence", "at", (F.col("first") - F.col("rank")).alias("shift"),
            F.greatest(F.col("rank") - F.col("first"), F.lit(0)).alias("own_from"), (last - F.col("first")).alias("own_to"),
        )
    )
    number = F.col("own") + F.col("shift")
    return (
        pieces.join(spans, ["length", "task"]).where((F.col("own") >= F.col("own_from")) & (F.col("own") < F.col("own_to")))
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("first_sequence") + F.floor(number / F.col("per"))).alias("sequence_id"),
            (F.col("at") + F.pmod(number, F.col("per")) * F.col("length")).alias("offset"),
        )
    )
