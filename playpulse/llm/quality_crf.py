"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its features are shares of kinds of characters, word lengths and
repetition, those of the lines before and after it, and whether the line came before; no id,
language or source. Lines of labelled documents carry the document's label. A document's
score is the mean of its lines' forward-backward marginals of good, weighted by length, over
the whole text.

Training takes labelled documents outside the held-out fold, about ``TRAIN_DOCS`` of them at
most, chosen by a hash of their id, of each one row and ``TRAIN_LINES`` lines in a row, from a
place that the hash gives, of ``TRAIN_CHARS`` characters at most; it runs in one task of that
bounded size. Labels other than 0 and 1 are ignored, documents labelled both are left out of
training; without labels of both kinds every score is the
share of good ones (one half without labels).

Null texts count as empty: one empty line. Null ids are not held out and not learned from;
repeated ids and rows give a row each; an empty table gives no row; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import id_and_text, ship_code, slices, staged, words_of
from playpulse.llm.crf import Crf, fit

FOLDS = 5
TRAIN_DOCS = 3000
TRAIN_LINES = 100
TRAIN_CHARS = 1000
CUT = 0.3

#: Classes of bytes: the characters of the first entries, then the rest by ranges.
KINDS = ["other", "lower", "upper", "digit", "space", "mark", "shout", "bar", "symbol", "wide"]


def byte_kinds() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    of = {name: i for i, name in enumerate(KINDS)}
    table[ord("a") : ord("z") + 1] = of["lower"]
    table[ord("A") : ord("Z") + 1] = of["upper"]
    table[ord("0") : ord("9") + 1] = of["digit"]
    table[128:] = of["wide"]
    for name, characters in (("space", b" \t\r\x0b\x0c"), ("mark", b".,;:?'\"()-"), ("shout", b"!"), ("bar", b"|"), ("symbol", b"#*$%&<>")):
        table[list(characters)] = of[name]
    return table


KIND_OF = byte_kinds()
UPPER, LOWER = KINDS.index("upper"), KINDS.index("lower")


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and where each text's lines begin (one entry more)."""
    lists = pc.split_pattern(texts, "\n")
    begins = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.values.slice(int(begins[0]), int(begins[-1] - begins[0]))
    begins = begins - begins[0]
    n = len(lines)
    lines = pa.concat_arrays([lines])  # its buffers begin with the first line
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + n + 1].astype(np.int64)
    buffer = lines.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    kinds = KIND_OF[data]
    if len(data) > 1:  # capital and small letters of Latin-1
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        kinds[after] = np.where(data[after] <= 0x9E, UPPER, LOWER)
    counts = np.bincount(np.repeat(np.arange(n) * len(KINDS), size) + kinds, minlength=n * len(KINDS)).reshape(n, len(KINDS)).astype(float)
    shares = counts / np.maximum(size, 1)[:, None]

    words, starts = words_of(lines)
    codes = words.indices.to_numpy().astype(np.int64)
    n_words = np.diff(starts)
    of_line = np.repeat(np.arange(n), n_words)
    pairs = np.unique(of_line * (len(words.dictionary) + 1) + codes) // (len(words.dictionary) + 1)
    distinct = np.bincount(pairs, minlength=n)
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (of_line[1:] == of_line[:-1])) + 1 if len(codes) else np.zeros(0, np.int64)
    adjacent = np.bincount(of_line[same], minlength=n)

    code = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    of_text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    _, first = np.unique(of_text * (code.max(initial=0) + 1) + code, return_index=True)
    again = np.ones(n)
    again[first] = 0
    again[n_words == 0] = 0

    some = np.maximum(n_words, 1)
    own = np.column_stack([
        shares[:, 1:], counts[:, UPPER] / np.maximum(counts[:, UPPER] + counts[:, LOWER], 1),
        np.minimum(size / some, 40) / 10, np.log1p(n_words), distinct / some, adjacent / some, again, n_words == 0,
        np.minimum(counts[:, KINDS.index("shout")] / some, 3), np.minimum(counts[:, KINDS.index("bar")] / some, 3), np.minimum(counts[:, KINDS.index("symbol")] / some, 4),
    ])
    before, behind = np.zeros_like(own), np.zeros_like(own)
    if n:
        inner = np.ones(n, bool)
        inner[begins[:-1]] = False
        at = np.flatnonzero(inner)
        before[at], behind[at - 1] = own[at - 1], own[at]
    return np.hstack([own, before, behind]), size, begins


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, train_docs: int) -> Crf | float:
    """The field, or the share of good documents where there is only one kind."""
    known = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("label"))
        .where("doc_id is not null and label in (0, 1)").withColumn("label", F.col("label").cast("int")).where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    )
    total, good = known.agg(F.count("*"), F.sum("label")).first()
    if not total or good in (0, total):
        return good / total if total else 0.5
    wide = 1 << 20
    share = min(wide, int(wide * train_docs / total))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(wide)) < share) if share < wide else known
    # at most about train_docs short rows, whatever the input
    lines = F.split("text", "\n")
    first = F.pmod(F.xxhash64("doc_id"), F.greatest(F.size(lines) - F.lit(TRAIN_LINES), F.lit(0)) + 1).cast("int")
    some = F.transform(F.slice(lines, first + 1, TRAIN_LINES), lambda x: F.substring(x, 1, TRAIN_CHARS))
    short = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.array_join(some, "\n").alias("text"))
    sample = staged(short.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled-documents")

    def learn(table: pa.Table) -> pa.Table:
        texts = table.column("text").combine_chunks()
        x, _, begins = line_features(texts)
        y = np.repeat(table.column("label").to_numpy(), np.diff(begins))
        crf = fit(x, y, begins)
        flat = [crf.mean, crf.scale, crf.weights.ravel(), crf.trans.ravel()]
        return pa.table({"weights": pa.array([np.concatenate(flat).tolist()], pa.list_(pa.float64()))})

    rows = sample.groupBy(F.lit(0).alias("one")).applyInArrow(learn, "weights array<double>").collect()
    if not rows:
        return good / total
    flat = np.array(rows[0]["weights"])
    n = (len(flat) - 2 - 4) // 4  # mean, scale, weights of two labels with a constant, 2 x 2 pairs
    return Crf(flat[:n], flat[n : 2 * n], flat[2 * n : 4 * n + 2].reshape(n + 1, 2), flat[4 * n + 2 :].reshape(2, 2))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_docs: int = TRAIN_DOCS,
    cut: float = CUT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, bad_lines, n_lines) of every row."""
    ship_code(docs.sparkSession)
    docs = id_and_text(docs, id_col, text_col)
    model = train(docs, labels, id_col, label_col, train_docs)

    def scored(batches):
        for part in slices(batches, "text"):
            x, size, begins = line_features(part.column(1))
            good = model.marginals(x, begins)[:, 1] if isinstance(model, Crf) else np.full(len(x), model)
            weight = size + 1.0
            score = np.clip(np.add.reduceat(good * weight, begins[:-1]) / np.add.reduceat(weight, begins[:-1]), 0.0, 1.0)
            bad = np.add.reduceat((good < 0.5).astype(np.int64), begins[:-1])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(score), pa.array((score >= cut).astype(np.int32)), pa.array(bad), pa.array(np.diff(begins))],
                ["doc_id", "score", "predicted", "bad_lines", "n_lines"],
            )

    result = docs.mapInArrow(scored, "doc_id long, score double, predicted int, bad_lines long, n_lines long")
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "bad_lines", "n_lines")
