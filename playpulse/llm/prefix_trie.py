"""Prefix tries of conversations: what their beginnings share, node by node.

A conversation is a sequence of turns (role, text); a turn's key is half of the SHA-256 of
both, so texts are read once and never shuffled. Sequences are cut into segments of
``SEGMENT`` turns; a segment begins at the node where the one before it ends, known by a key
of all turns before it. Equal segments at one node are counted before anything else.

Segments are dealt to shards by that node and their first turn; if the most frequent of these
has more than ``SHARD_SEGMENTS`` of them, each is dealt to several. A task gives the turns of its shard dense
ids, packs the trie of its segments into the arrays BASE and CHECK (``double_array``) and
walks it: the number of conversations and the smallest one of every node. Nodes that several
shards have in common, the upper ones, are merged by their keys.

A node is then named by its smallest conversation and its depth. The nodes of one name's
conversation form a chain downwards, and chains hang on chains of smaller names. What is
summed over subtrees is summed along each chain, and a chain's total is handed to the chains
above it, level by level; their number is that of name changes on a way to the root, which
grows like the logarithm of the number of conversations for unordered ids. Long chains and
conversations are numbered and summed in slabs of ``SLAB`` turns, so none is one task's work.

The hash over a node's ends is by its nature one pass over their ids: tasks join ranges of
them to text first, and only these texts meet, streamed, in the node's task.

Turns count in the order of ``turn`` (null first), ties by role and then by key; null roles
and texts count as empty; rows without a conversation id are left out; repeated rows are
turns of their own; an empty table gives no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import shared_setting, ship_code, staged, text_of
from playpulse.llm.crc_sql import crc32_sql
from playpulse.llm.double_array import DoubleArray

SEGMENT = 64
SHARD_SEGMENTS = 5000
SLAB = 1024
CHUNK_IDS = 100_000  # ids joined to one text before a node's ends are hashed
DECADE = 20  # conversations that begin like the first of them
HEADS = 4  # its first 0 .. HEADS - 1 turns
KEY_BYTES = 16

NODE = "key binary, up binary, depth long, n long, low long, words long"


def key_of(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 2 * KEY_BYTES))


TOP = hashlib.sha256(b"").digest()[:KEY_BYTES]  # stands for what comes before the first segment
ROOT_KEY = hashlib.sha256(TOP).digest()[:KEY_BYTES]


def turns_of(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, p, key, words): the turns of every conversation, numbered from 1."""
    role, text = text_of(role_col), text_of(text_col)
    keyed = rows.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"),
        key_of(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).where("conv_id is not null")
    keyed = keyed.withColumn("slab", F.floor(F.col("turn") / SLAB))
    counts = keyed.groupBy("conv_id", "slab").agg(F.count("*").alias("many"))
    before = Window.partitionBy("conv_id").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conv_id").alias("c"), F.coalesce("slab", F.lit(-(1 << 62))).alias("s"), F.coalesce(F.sum("many").over(before), F.lit(0)).alias("earlier")
    )
    own = F.row_number().over(Window.partitionBy("conv_id", "slab_key").orderBy("turn", "role", "key"))
    keyed = keyed.withColumn("slab_key", F.coalesce("slab", F.lit(-(1 << 62))))
    return (
        keyed.withColumn("own", own).join(counts, (F.col("conv_id") == F.col("c")) & (F.col("slab_key") == F.col("s")))
        .select("conv_id", (F.col("own") + F.col("earlier")).alias("p"), "key", "words")
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first turns from the first one of their decade.

    Returns (conv_id) of all and (conv_id, p, key, words) of their turns. Of a conversation c the
    first h (its id's CRC-32 mod HEADS) are those of c - c % DECADE, all if that has fewer,
    none if it isn't there.
    """
    counts = staged(turns.groupBy("conv_id").agg(F.count("*").alias("many")), "turn-counts")
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    first = F.col("conv_id") - F.col("conv_id") % DECADE
    firsts = counts.select(F.col("conv_id").alias("first"), F.col("many").alias("there"))
    convs = staged(
        counts.select("conv_id", heads.alias("h"), first.alias("first")).join(firsts, "first", "left")
        .select("conv_id", "first", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "conversations",
    )
    own = turns.join(convs, "conv_id").where("p > h").select("conv_id", (F.col("p") - F.col("h") + F.col("taken")).alias("p"), "key", "words")
    begins = turns.where(F.col("p") < HEADS).withColumnRenamed("conv_id", "first").join(convs, "first").where("p <= taken")
    return convs.select("conv_id"), own.union(begins.select("conv_id", "p", "key", "words"))


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, k, keys, words, root, up, end): the segments, the node above each, and the nodes' keys.

    ``root`` names all turns before the segment, ``up`` is the node that it begins at, ``end``
    the one that it ends at.
    """
    k = F.floor((F.col("p") - 1) / SEGMENT)
    parts = turns.withColumn("k", k).groupBy("conv_id", "k").agg(F.sort_array(F.collect_list(F.struct("p", "key", "words"))).alias("turns"))
    joined = lambda first: F.aggregate(F.col("turns.key"), first, lambda a, x: F.concat(a, x))
    parts = parts.withColumn("own", key_of(joined(F.lit(b"").cast("binary"))))
    row = Window.partitionBy("conv_id").orderBy("k")
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    mixed = lambda *more: F.bit_xor(F.xxhash64("own", "k", *more)).over(before)
    path = F.concat_ws(":", F.col("k").cast("string"), mixed().cast("string"), mixed(F.lit(1)).cast("string"))
    rooted = parts.withColumn("root", F.when(F.col("k") == 0, F.lit(TOP)).otherwise(key_of(path.cast("binary"))))
    ended = rooted.withColumn("end", key_of(joined(F.col("root"))))
    return ended.select(
        "conv_id", "k", F.col("turns.key").alias("keys"), F.col("turns.words").alias("words"), "root",
        F.coalesce(F.lag("end").over(row), F.lit(ROOT_KEY)).alias("up"), "end",
    )


def walk_shard(rows: pa.Table) -> pa.Table:
    """The nodes of one shard's segments."""
    roots, keys = rows.column("root").to_pylist(), rows.column("keys").to_pylist()
    dense = {key: i + 1 for i, key in enumerate(dict.fromkeys([*roots, *(x for s in keys for x in s)]))}
    symbols = [(dense[r], *(dense[x] for x in s)) for r, s in zip(roots, keys, strict=True)]
    order = sorted(range(len(symbols)), key=symbols.__getitem__)
    trie = DoubleArray([symbols[i] for i in order])
    nodes: dict[int, list] = {}
    words, ups, ks = rows.column("words").to_pylist(), rows.column("up").to_pylist(), rows.column("k").to_pylist()
    for i, n, low in zip(range(len(symbols)), rows.column("n").to_pylist(), rows.column("low").to_pylist(), strict=True):
        up, made = ups[i], None
        for j, state in enumerate(trie.walk(symbols[i])):
            if j == 0:
                continue  # the node that the segment begins at
            node = nodes.get(state)
            if node is None:
                if made is None:
                    made = hashlib.sha256(roots[i] + b"".join(keys[i][: j - 1]))
                made.update(keys[i][j - 1])
                node = nodes[state] = [made.digest()[:KEY_BYTES], up, ks[i] * SEGMENT + j, 0, low, words[i][j - 1]]
            node[3] += n
            node[4] = min(node[4], low)
            up = node[0]
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 4]
    columns = list(zip(*nodes.values(), strict=True)) or [[]] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in NODE.split(", ")])


def nodes_of(parts: DataFrame, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(key, up, depth, n, low, words) of every node but the root."""
    distinct = staged(
        parts.groupBy("end").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("low"), *[F.first(c).alias(c) for c in ("k", "keys", "words", "root", "up")]
        ), "segments",
    )
    first = F.get("keys", F.lit(0))
    total, most = distinct.groupBy("root", first.alias("first")).agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    shards, parts = (max(1, -(-(n or 0) // shard_segments)) for n in (total, most))
    dealt = distinct.withColumn("part", F.pmod(F.xxhash64("end"), F.lit(parts)))
    shard = F.pmod(F.xxhash64("root", first, "part"), F.lit(shards))
    found = dealt.select(shard.alias("shard"), "root", "up", "k", "keys", "words", "n", "low").groupBy("shard").applyInArrow(walk_shard, NODE)
    return found.groupBy("key").agg(
        F.first("up").alias("up"), F.first("depth").alias("depth"), F.sum("n").alias("n"), F.min("low").alias("low"), F.first("words").alias("words")
    )


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): of each node the hash over its ids, rising and joined by commas."""

    def joined(batches):
        key, ids = None, []

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "ids"]
            )

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (k != key or len(ids) == CHUNK_IDS):
                    yield chunk()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield chunk()

    def hashed(batches):
        key, made = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([made.hexdigest()])], ["key", "ends_sha256"])

        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if made is None or k != key:
                    if made is not None:
                        yield row()
                    key, made = k, hashlib.sha256(ids.encode())
                else:
                    made.update(b"," + ids.encode())
        if made is not None:
            yield row()

    width = shared_setting(ends.sparkSession, "spark.sql.shuffle.partitions", 200)
    ranges = ends.select("key", "conv_id").repartitionByRange(width, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranges.mapInArrow(joined, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def to_the_end(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (conv_id, depth, ...), each of ``columns`` summed from the row's depth to the chain's end."""
    rows = rows.withColumn("slab", F.floor(F.col("depth") / SLAB))
    below = Window.partitionBy("conv_id").orderBy(F.desc("slab")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "slab").agg(*[F.sum(c).alias(f"all_{c}") for c in columns])
    later = totals.select("conv_id", "slab", *[F.coalesce(F.sum(f"all_{c}").over(below), F.lit(0)).alias(f"later_{c}") for c in columns])
    own = Window.partitionBy("conv_id", "slab").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("conv_id", "depth", "slab", *[F.sum(c).over(own).alias(c) for c in columns])
    return summed.join(later, ["conv_id", "slab"]).select("conv_id", "depth", *[(F.col(c) + F.col(f"later_{c}")).alias(c) for c in columns])


def subtree_sums(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(conv_id, depth) and ``columns`` summed over each node's subtree.

    ``nodes`` (conv_id, depth, parent, ...) is stored; ``parent`` is the parent's conversation.
    """
    head = F.when(F.col("parent") != F.col("conv_id"), F.col("parent"))
    sums = [F.sum(c).alias(c) for c in columns]
    chains = staged(nodes.groupBy("conv_id").agg(F.max(head).alias("parent"), (F.min("depth") - 1).alias("at"), *sums).where("parent is not null"), "chains")
    handed = chains.select(F.col("parent").alias("conv_id"), F.col("at").alias("depth"), *columns)
    all_handed, level = [handed], handed
    while True:  # a level of chains a round
        level = staged(
            level.groupBy("conv_id").agg(*sums).join(chains.select("conv_id", "parent", "at"), "conv_id")
            .select(F.col("parent").alias("conv_id"), F.col("at").alias("depth"), *columns), "handed",
        )
        if not level.limit(1).count():
            break
        all_handed.append(level)
    own = nodes.select("conv_id", "depth", *columns)
    for rows in all_handed:
        own = own.union(rows.select("conv_id", "depth", *columns))
    return to_the_end(own.groupBy("conv_id", "depth").agg(*sums), columns)


def prefix_trie(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shape: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    shard_segments: int = SHARD_SEGMENTS,
) -> DataFrame:
    """A row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``shape`` changes the turns before the trie is built (``rebuilt``), as (all conversations,
    their turns); without it they are taken as they are.
    """
    spark = rows.sparkSession
    ship_code(spark)
    turns = staged(turns_of(rows, conv_col, turn_col, role_col, text_col), "turns")
    convs, turns = shape(turns) if shape else (turns.select("conv_id").distinct(), turns)
    convs = staged(convs, "conversations")
    parts = staged(segments(turns), "parts")
    total, lowest = convs.agg(F.count("*"), F.min("conv_id")).first()
    found = staged(nodes_of(parts, shard_segments), "nodes")
    above = found.select(F.col("key").alias("up"), F.col("low").alias("parent"))
    deeper = found.where("depth > 1").join(above, "up")
    columns = ["key", F.col("low").alias("conv_id"), "depth", "parent", "n", "words"]
    named = deeper.select(*columns).union(found.where("depth = 1").withColumn("parent", F.lit(lowest).cast("long")).select(*columns))
    if total:
        top = [(bytearray(ROOT_KEY), lowest, 0, None, total, 0)]
        named = named.union(spark.createDataFrame(top, "key binary, conv_id long, depth long, parent long, n long, words long"))
    named = staged(named, "named-nodes")

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    as_parent = named.where("parent is not null").select(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"), none, zero, zero, (zero + 1))
    counted = (
        named.select("conv_id", "depth", "parent", "n", "words", zero.alias("children")).union(as_parent)
        .groupBy("conv_id", "depth").agg(F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in ("n", "words", "children")])
        .withColumn("leaves", (F.col("children") == 0).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("words"))
    )
    counted = staged(counted, "counted-nodes")
    sums = subtree_sums(counted, ["leaves", "saved"])
    last = parts.groupBy("conv_id").agg(F.max("k").alias("k")).join(parts.select("conv_id", "k", "end"), ["conv_id", "k"])
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("end", F.lit(ROOT_KEY)).alias("key"), "conv_id")
    hashes = hashed_ends(ends).join(named.select("key", "conv_id", "depth"), "key").select("conv_id", "depth", "ends_sha256")
    return (
        counted.drop("leaves", "saved").join(sums, ["conv_id", "depth"]).join(hashes, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def sql() -> str:
    """The query over ``conversations``, rebuilt, in DuckDB SQL: prefixes as lists of turns, compared with one another."""
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, '') AS role,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key, {words} AS words
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, key, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) AS p FROM keyed),
convs AS (SELECT DISTINCT conv_id AS c, {crc32_sql("conv_id::VARCHAR")} % {HEADS} AS h FROM turns),
rebuilt AS (
  SELECT c, 0 AS part, p, key, words FROM convs JOIN turns ON conv_id = c - c % {DECADE} WHERE p <= h
  UNION ALL SELECT c, 1, p, key, words FROM convs JOIN turns ON conv_id = c WHERE p > h),
pathed AS (
  SELECT c, words, row_number() OVER w AS depth, list(key) OVER w AS path FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY part, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
members AS (
  SELECT c, depth, path, words FROM pathed UNION ALL SELECT c, 0, []::VARCHAR[], 0 FROM convs),
lengths AS (SELECT c, max(depth) AS last FROM members GROUP BY c),
nodes AS MATERIALIZED (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n, any_value(words) AS words,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = last), '') AS ends
  FROM members JOIN lengths USING (c) GROUP BY path, depth),
kids AS (SELECT path[:-2] AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1),
filled AS MATERIALIZED (
  SELECT n.*, coalesce(children, 0) AS children, u.conv_id AS parent
  FROM nodes n LEFT JOIN kids USING (path) LEFT JOIN nodes u ON n.depth > 0 AND u.path = n.path[:-2]),
sums AS (
  SELECT a.path, count(*) FILTER (WHERE b.children = 0) AS leaves, sum((b.n - 1) * b.words) AS saved
  FROM (SELECT path, children, n, words, unnest(range(0, depth + 1)) AS above FROM filled) b
  JOIN filled a ON a.path = b.path[:b.above] GROUP BY a.path)
SELECT conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n::BIGINT AS n_convs, children::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM filled JOIN sums USING (path)"""
