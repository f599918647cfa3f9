"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Documents with equal sets of word shingles are one set, known by a 64-bit key; everything
below works on sets. Let n be a set's size and t the similarity.

1. ``signatures``: size and key of every document, and a count of all shingles in slots by
   hash. Slots far above the mean are hot; there are at most an eighth as many as slots, so
   they may be broadcast.
2. ``prefixes``: every shingle goes, in blocks, to its hash range, which finds how many texts
   hold it and returns those that two or more hold. Shingles of hot slots skip the range (no
   task gathers a frequent shingle's documents) and count as frequent as their slot. Per set,
   shingles are ordered rare first and those among the first n - ceil(t n) + 1 are kept.
3. Candidates share a prefix shingle. A bucket of m sets must not give m * m pairs: first
   every set is compared with one centre of its bucket, twice with different centres. Only
   pairs that these links leave in different components remain, and of those only the ones
   that pass the length and the positional filter; a bucket's largest component is never
   paired with itself. No link between different components is lost, as such a pair is
   compared whatever the bucket's size.
4. Each pair is verified once, on whole sets of 64-bit hashes: a suffix filter that bounds the
   overlap by counts between fixed pivots, then the exact intersection.

Sets with equal keys but different second hashes would be two sets taken for one; that is
checked and raises (expected once in about 10**9 documents' pairs at 2**64).

Null and empty texts and texts without words have no shingle, link with nothing and are
their own component (a null id: null). Null ids take part but don't name a component that
has an id; repeated ids and rows give a row each; an empty table gives no row; further
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import free_name, id_and_text, shared_setting, ship_code, slices, staged, temporary, text_of
from playpulse.llm.components import components
from playpulse.llm.shingles import WORDS, set_keys, shingle_sets

PERCENT = 75
HOT = 8  # times the mean of a slot
CENTRES = 2
PIVOTS = 64
SLICE_BYTES = 4 << 20  # of text at once; its shingles take some thirty times as much
RANGE_SHINGLES = 1 << 19  # shingles of a hash range, which is one group
FILTER_BITS = 1 << 24  # of the filter that spares documents without a candidate; larger inputs only spare less


def power_of_two(n: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, n))))


def signatures(docs: DataFrame, words: int, slots: int) -> DataFrame:
    """Rows of kind 0 (doc_id, n, key, check, hash of the text) for documents and of kind 1 (slot, count)."""
    shift = np.uint64(64 - int(math.log2(slots)))

    def signed(batches):
        counts = np.zeros(slots, np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            hashes, begins = shingle_sets(part.column(1), words)
            counts += np.bincount((hashes >> shift).astype(np.int64), minlength=slots)
            key, check = set_keys(hashes, begins)
            n = np.diff(begins)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(n), np.int32)), part.column(0), pa.array(n), pa.array(key, mask=n == 0), pa.array(check, mask=n == 0),
                    part.column(2),
                ],
                names,
            )
        used = np.flatnonzero(counts)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(used), np.int32)), pa.array(used), pa.array(counts[used]), none, none, none], names
        )

    names = ["kind", "doc_id", "n", "key", "chk", "text_hash"]
    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        signed, "kind int, doc_id long, n long, key long, chk long, text_hash long"
    )


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return at, np.diff(np.concatenate((at, [len(values)])))


def packed_steps(ascending: np.ndarray) -> bytes:
    """Steps between ascending numbers, a byte each where all fit, else two."""
    step = np.diff(ascending, prepend=0)
    return step.astype("<u1" if step.max(initial=0) < 256 else "<u2").tobytes()


def unpacked_steps(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u1" if len(data) == n else "<u2"), dtype=np.int64)


GRAM_BITS = 24  # that a gram has below its range


def packed_grams(low: np.ndarray) -> tuple[bytes, bytes]:
    return (low & 0xFFFF).astype("<u2").tobytes(), (low >> 16).astype("<u1").tobytes()


def unpacked_grams(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u2").astype(np.int64) | (np.frombuffer(high, "<u1").astype(np.int64) << 16)


COLUMNS = ["part", "block", "range", "docs", "low", "high", "codes"]
BLOCK_ROWS = "part long, block long, range long, docs binary, low binary, high binary, codes binary"
BLOCK_DOCS = 50_000


def block_rows(part: list, block: list, range_: list, docs: list, low: list, high: list, codes: list) -> pa.RecordBatch:
    ints = [pa.array(x, pa.int64()) for x in (part, block, range_)]
    return pa.RecordBatch.from_arrays([*ints, *[pa.array(x, pa.binary()) for x in (docs, low, high, codes)]], COLUMNS)


def frequency_code(counts: np.ndarray) -> np.ndarray:
    """Counts on a fine logarithmic scale of two bytes, for ordering alone."""
    return np.round(1000 * np.log2(np.maximum(counts, 1))).astype("<u2")


def prefixes(docs: DataFrame, words: int, percent: int, ranges: int, slot_counts: np.ndarray) -> DataFrame:
    """(gram, key, n, pos): the prefix shingles that other sets may hold, at their place in the rare-first order.

    A gram is a shingle's range and ``GRAM_BITS`` more bits of its hash; two shingles with one
    gram only add candidates. Texts go in blocks of bounded size: a shingle travels to its
    range as its gram and its text's number in the block, and back to its block if others hold
    it too. A block's header with its sets' keys and sizes goes along by a group of its own.
    """
    bits = int(math.log2(ranges))
    slot_bits = int(math.log2(len(slot_counts)))
    gram_shift = np.uint64(64 - bits - GRAM_BITS)
    block_bytes = SLICE_BYTES * min(8, max(1, ranges // 4096))  # with many ranges, larger blocks for rows that are worth it

    def dealt(batches):
        task, seen, made = TaskContext.get().partitionId(), set(), 0
        for whole in slices(batches, "text", block_bytes):
            for start in range(0, whole.num_rows, BLOCK_DOCS):
                part = whole.slice(start, BLOCK_DOCS)
                block = (task << 32) + made
                made += 1
                hashes, begins = shingle_sets(part.column(1), words)
                key, _ = set_keys(hashes, begins)
                n = np.diff(begins)
                new = np.zeros(len(n), bool)
                for i in np.flatnonzero(n):
                    if key[i] not in seen:
                        seen.add(key[i])
                        new[i] = True
                hashes = hashes[np.repeat(new, n)]
                key, n = key[new], n[new]
                if not len(n):
                    continue
                doc = np.repeat(np.arange(len(n)), n)
                counts = slot_counts[(hashes >> np.uint64(64 - slot_bits)).astype(np.int64)]
                grams = (hashes >> gram_shift).astype(np.int64)
                # a hot shingle goes round its range, with its block's own group
                through = ranges + block % ranges
                group = np.where(counts > 0, ranges, grams >> GRAM_BITS).astype(np.int32)
                order = np.argsort(group, kind="stable")
                group, doc, grams, counts = group[order], doc[order], grams[order], counts[order]
                at, length = runs(group)
                rows: list[list] = [[] for _ in COLUMNS]
                for a, b in zip(at.tolist(), (at + length).tolist(), strict=True):
                    if group[a] < ranges:
                        row = (int(group[a]), block, int(group[a]), packed_steps(doc[a:b]), *packed_grams(grams[a:b] & ((1 << GRAM_BITS) - 1)), b"")
                    else:
                        row = (through, block, ranges, packed_steps(doc[a:b]), grams[a:b].astype("<i8").tobytes(), b"", frequency_code(counts[a:b]).tobytes())
                    for c, v in zip(rows, row, strict=True):
                        c.append(v)
                for c, v in zip(rows, (through, block, -1, key.astype("<i8").tobytes(), n.astype("<i8").tobytes(), b"", b""), strict=True):
                    c.append(v)
                yield block_rows(*rows)

    def shared(group: tuple, table: pa.Table) -> pa.Table:
        if group[0].as_py() >= ranges:
            return table.set_column(0, "part", table.column("block"))
        blocks, docs, lows, highs = (table.column(c).to_pylist() for c in ("block", "docs", "low", "high"))
        sizes = np.array([len(x) for x in highs])
        grams = np.concatenate([unpacked_grams(x, y) for x, y in zip(lows, highs, strict=True)])
        order = np.argsort(grams, kind="stable")
        _, length = runs(grams[order])
        held = np.empty(len(grams), np.int64)
        held[order] = np.repeat(length, length)
        rows: list[list] = [[] for _ in COLUMNS]
        end = 0
        for block, doc, n in zip(blocks, docs, sizes.tolist(), strict=True):
            start, end = end, end + n
            many = held[start:end] > 1
            if many.any():
                row = (
                    block, block, group[0].as_py(), packed_steps(unpacked_steps(doc, n)[many]), *packed_grams(grams[start:end][many]),
                    frequency_code(held[start:end][many]).tobytes(),
                )
                for c, v in zip(rows, row, strict=True):
                    c.append(v)
        return pa.Table.from_batches([block_rows(*rows)])

    def first_ones(table: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[], [], []]
        keys = sizes = np.zeros(0, np.int64)
        for range_, docs, low, high, codes in zip(*(table.column(c).to_pylist() for c in COLUMNS[2:]), strict=True):
            if range_ < 0:
                keys, sizes = np.frombuffer(docs, "<i8"), np.frombuffer(low, "<i8")
                continue
            grams = np.frombuffer(low, "<i8") if range_ == ranges else unpacked_grams(low, high) | (range_ << GRAM_BITS)
            for c, v in zip(parts, (unpacked_steps(docs, len(grams)), grams, np.frombuffer(codes, "<u2")), strict=True):
                c.append(v)
        doc, grams, codes = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in parts)
        order = np.lexsort((grams, codes, doc))
        doc, grams = doc[order], grams[order]
        begin, length = runs(doc)
        n = sizes[doc]
        pos = np.arange(len(doc)) - np.repeat(begin, length) + n - np.repeat(length, length)
        kept = pos < n + (-percent * n // 100) + 1  # n - ceil(t n) + 1
        return pa.table({"gram": grams[kept], "key": keys[doc[kept]], "n": n[kept].astype(np.int32), "pos": pos[kept].astype(np.int32)})

    return (
        docs.mapInArrow(dealt, BLOCK_ROWS)
        .groupBy("part").applyInArrow(shared, BLOCK_ROWS)
        .groupBy("part").applyInArrow(first_ones, "gram long, key long, n int, pos int")
        .distinct()  # copies of a set come from several blocks
    )


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(key, hashes) of the documents whose ids are ``wanted``, and of a few more."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1  # bitmap buckets are numbered 0 for 0, 1 from 1 on
    rows = (
        wanted.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("b"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()  # FILTER_BITS at most
    )
    flags = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)
    for r in rows:
        flags[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(flags)
    at = F.bitmap_bucket_number("slot") * 32768 - 32768 + F.bitmap_bit_position("slot")

    def sets(batches):
        bits = shared.value
        for batch in batches:
            where = batch.column(1).to_numpy(zero_copy_only=False)
            hit = (bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1
            for part in slices([batch.filter(pa.array(hit.astype(bool)))], "text", SLICE_BYTES):
                hashes, begins = shingle_sets(part.column(0), words)
                key, _ = set_keys(hashes, begins)
                for i in np.flatnonzero(np.diff(begins)).tolist():
                    yield pa.RecordBatch.from_pydict({"key": [int(key[i])], "hashes": [hashes[begins[i] : begins[i + 1]].tobytes()]})

    def gathered(batches):
        rows, size = [], 0
        for b in batches:
            rows.append(b)
            size += b.nbytes
            if size > 4 << 20:
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                rows, size = [], 0
        if rows:
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]

    found = docs.withColumn("slot", slot).select("text", at.alias("at"))
    return found.mapInArrow(lambda batches: gathered(sets(batches)), "key long, hashes binary").groupBy("key").agg(F.first("hashes").alias("hashes"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b): the pairs whose sets are similar enough."""

    def linked(batches):
        for batch in batches:
            keep = []
            xs, ys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for x, y in zip(xs, ys, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = -(-percent * (len(x) + len(y)) // (100 + percent))
                keep.append(overlap_bound(x, y) >= need and len(np.intersect1d(x, y, assume_unique=True)) >= need)
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    of_b = sets.select(F.col("key").alias("b"), F.col("hashes").alias("hashes_b"))
    of_a = sets.select(F.col("key").alias("a"), F.col("hashes").alias("hashes_a"))
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "hashes_a", "hashes_b")
    return both.mapInArrow(linked, "a long, b long")


EDGES = (np.arange(1, PIVOTS, dtype=np.uint64) << np.uint64(64 - int(math.log2(PIVOTS)))).astype(np.uint64)


def overlap_bound(x: np.ndarray, y: np.ndarray) -> int:
    """Suffix filter: no more common elements than the smaller count between two pivots, summed."""
    a = np.diff(np.concatenate(([0], np.searchsorted(x, EDGES), [len(x)])))
    b = np.diff(np.concatenate(([0], np.searchsorted(y, EDGES), [len(y)])))
    return int(np.minimum(a, b).sum())


def similar_length(percent: int):
    return F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent


def centre_pairs(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each set of a bucket with the bucket's centre, where they are in different components.

    First the set in which the gram comes earliest: it has the fewest rare shingles, as the
    text that its bucket's near copies were made from; then others by a hash.
    """
    early = F.col("pos") if turn == 0 else F.lit(0)
    first = F.min(F.struct(early.alias("early"), F.xxhash64("key", F.lit(turn)).alias("h"), "key", "n", "comp"))
    centres = staged(
        entries.groupBy("gram").agg(first.alias("c"), F.count("*").alias("m")).where("m > 1")
        .select("gram", F.col("c.key").alias("other"), F.col("c.n").alias("other_n"), F.col("c.comp").alias("other_comp")),
        "centres",
    )
    return (
        entries.join(centres, "gram").where((F.col("comp") != F.col("other_comp")) & similar_length(percent))
        .select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    )


def crossing(entries: DataFrame, comps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with their component in buckets of several components, and each bucket's largest component."""
    placed = staged(
        entries.join(comps, "key", "left").select("gram", "key", "n", "pos", F.coalesce("comp", "key").alias("comp")), "placed"
    )
    largest = staged(
        placed.groupBy("gram", "comp").agg(F.count("*").alias("m"))
        .groupBy("gram").agg(F.max(F.struct("m", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
        .select("gram", F.col("top.comp").alias("top")),
        "largest",
    )
    return staged(placed.join(largest, "gram"), "crossing"), largest


def remaining_pairs(cross: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket in different components that pass the length and the positional filter."""
    one = cross.where("comp != top").select("gram", "key", "n", "pos", "comp")
    other = cross.select("gram", *[F.col(c).alias(f"other_{c}") for c in ("key", "n", "pos", "comp")], "top")
    need = F.ceil(percent * (F.col("n") + F.col("other_n")) / F.lit(100 + percent))
    reach = 1 + F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos")) - 1
    apart = (F.col("comp") != F.col("other_comp")) & ((F.col("other_comp") == F.col("top")) | (F.col("key") < F.col("other_key")))
    return (
        one.join(other, "gram").where(apart & similar_length(percent) & (reach >= need))
        .select(F.least("key", "other_key").alias("a"), F.greatest("key", "other_key").alias("b")).distinct()
    )


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_verified, text_hash) of every row.

    ``component_id``: the smallest id reachable by links; ``n_verified``: verified links of the
    document's set with other sets (of a bucket's pairs within a component, those that were compared).
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = id_and_text(docs, id_col, text_col)
    with temporary(spark):
        slots = max(1 << 14, 16 * power_of_two(shared_setting(spark, "spark.sql.shuffle.partitions", 200)))
        signed = staged(signatures(docs, words, slots), "signatures")
        keyed = signed.where("kind = 0").drop("kind")
        if keyed.where("key is not null").groupBy("key").agg(F.min("chk").alias("l"), F.max("chk").alias("h")).where("l != h").limit(1).count():
            raise ValueError("two different shingle sets have the same 64-bit key")
        per_slot = signed.where("kind = 1").groupBy(F.col("doc_id").alias("slot")).agg(F.sum("n").alias("n"))
        total = per_slot.agg(F.sum("n")).first()[0] or 0
        slot_counts = np.zeros(slots, np.int64)
        for r in per_slot.where(F.col("n") >= max(HOT, HOT * total / slots)).collect():  # slots / HOT rows at most
            slot_counts[r["slot"]] = r["n"]
        ranges = max(64, power_of_two(total // RANGE_SHINGLES))
        entries = staged(prefixes(docs, words, percent, ranges, slot_counts), "prefixes")

        wanted = (
            entries.join(entries.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1"), "gram", "left_semi").select("key").distinct()
            .join(keyed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")), "key").select("doc_id")
        )
        sets = staged(whole_sets(docs, wanted, words), "sets")
        compared = links = comps = None
        left = entries.withColumn("comp", F.col("key"))
        for turn in range(CENTRES):
            pairs = centre_pairs(left, turn, percent)
            pairs = staged(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
            compared = pairs if compared is None else compared.union(pairs)
            found = staged(verified(pairs, sets, percent), "links")
            links = found if links is None else links.union(found)
            comps = components(links)
            left = crossing(left.select("gram", "key", "n", "pos"), comps)[0]
        pairs = remaining_pairs(left, percent).join(compared, ["a", "b"], "left_anti")
        found = staged(verified(staged(pairs, "pairs"), sets, percent), "links")
        links = staged(links.union(found), "links")
        comps = components(links)

        ends = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(F.count("*").alias("n_verified"))
        known = staged(comps.join(ends, "key", "left"), "components")
        placed = staged(keyed.join(known, "key", "left").select("doc_id", "text_hash", "n", F.coalesce("comp", "key").alias("comp"), F.coalesce("n_verified", F.lit(0).cast("long")).alias("n_verified")), "placed", keep=True)
        names = staged(
            placed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("name"), F.count("*").alias("m")).where("m > 1").drop("m"), "names", keep=True
        )
    return placed.join(names, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("name", "doc_id").alias("component_id"), "n_verified", "text_hash"
    )


def one_of_each_group(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates, with all their columns.

    Of a component the document that names it stays, once if its row is repeated. Documents
    without a shingle all stay; those with a null id stay if no document of their component
    has an id.
    """
    judged = jaccard_components(docs, words, percent, id_col, text_col)
    n = {k: free_name(docs, f"group_{k}") for k in ("id", "hash", "empty", "copy")}
    stays = judged.where(F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("n_shingles") == 0)).select(
        F.col("doc_id").alias(n["id"]), F.col("text_hash").alias(n["hash"]), (F.col("n_shingles") == 0).alias(n["empty"])
    )
    hashed = docs.withColumn(n["copy"], F.xxhash64(text_of(text_col)))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(n["id"])) & (F.col(n["copy"]) == F.col(n["hash"]))
    rows = hashed.join(stays.distinct(), same)
    copy = F.row_number().over(Window.partitionBy(n["id"], n["hash"]).orderBy(n["hash"]))
    return rows.withColumn(n["copy"], copy).where((F.col(n["copy"]) == 1) | F.col(n["empty"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def sql(words: int = WORDS, percent: int = PERCENT) -> str:
    """Components over ``documents`` in DuckDB SQL: all pairs that share a shingle, by an inverted index."""
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT rid, gram FROM (
    SELECT rid, unnest(CASE WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: {gram}) END) AS gram FROM texts WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT rid, count(*) AS n FROM grams GROUP BY rid),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM grams x JOIN grams y ON x.gram = y.gram AND x.rid < y.rid GROUP BY ALL)
  JOIN sizes p ON p.rid = a JOIN sizes q ON q.rid = b WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT rid, rid AS other FROM texts UNION SELECT reach.rid, edges.b FROM reach JOIN edges ON edges.a = reach.other),
names AS (SELECT r.rid, min(t.doc_id) AS component_id FROM reach r JOIN texts t ON t.rid = r.other GROUP BY r.rid)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM texts JOIN names USING (rid) LEFT JOIN sizes USING (rid)"""
