"""Exact top-k search by integer inner product with a KD-tree per shard.

Components count as floor(256 x). Rows are dealt by a hash of their id into shards of about
``SHARD_ROWS``; a task turns a shard into a KD-tree by median splits along the widest side,
each node with its tight bounding box. The queries, a stated set, go in blocks of
``QUERY_BLOCK`` to every shard. A block searches one shard first; the kth scores found there
start its search of all other shards, so most of their boxes are never opened. Within a
shard nodes are taken best first: the bound of a box is the largest inner product that a
point in it could have, and the search ends when no box reaches the kth score (boxes that
only equal it are opened, as a smaller id wins a tie).

Vectors that are null or hold a null or non-finite component take no part, nor do rows with a
null id; vectors are compared with those of the same length only; rows that share the query's
id are no candidates; a repeated row is as many candidates, but a query has one result: that
of its first row by vector. Scores are exact while they fit 64 bits, beyond that an error is
raised. No queries or an empty table give no row; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import ship_code, staged

K = 5
SHARD_ROWS = 8192
QUERY_BLOCK = 512
LEAF = 128
EXACT = 2.0**53  # whole numbers below it are exact as doubles


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, 256 times the vector, dim) of the rows that take part."""
    vector = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: 256 * x)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    return out.select("vec_id", "v", F.size("v").alias("dim"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.floor(column.combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dim)


class Tree:
    """Nodes by number: boxes, children (0 for a leaf), and the points' range."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((ids,))
        low, high, children, span = [], [], [], []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            at, rows = len(span), points[order[a:b]]
            if parent >= 0:
                children[parent][side] = at
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            low.append(lo), high.append(hi), children.append([0, 0]), span.append((a, b))
            if b - a > leaf and (hi > lo).any():
                m = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, int(np.argmax(hi - lo))], m)]
                stack += [(a + m, b, at, 1), (a, a + m, at, 0)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)
        self.children, self.span = children, span


def exact_product(points: np.ndarray, queries: np.ndarray):
    """A product of rows that is exact for these points and queries: by doubles where they suffice."""
    size = max(1, points.shape[1]) * max(np.abs(points).max(initial=0), 1.0) * max(np.abs(queries).max(initial=0), 1.0)
    if size < EXACT:
        return lambda a, b: a @ b.T

    def whole(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = (np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b))
        out = a @ b.T
        if out.size and max(abs(out.min()), abs(out.max())) >= 2**63:
            raise OverflowError("an inner product doesn't fit 64 bits")
        return out

    return whole


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, least: list, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's best k here that reach its ``least`` score (None: any)."""
    product = exact_product(tree.points, queries)
    bounds = product(np.maximum(queries, 0), tree.high) + product(np.minimum(queries, 0), tree.low)
    out = []
    for q, (own, vector) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        floor = least[q]
        heap = [(-bounds[q, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if floor is not None and -bound < floor:
                break
            if tree.children[node][0]:
                for child in tree.children[node]:
                    if floor is None or bounds[q, child] >= floor:
                        heapq.heappush(heap, (-bounds[q, child], child))
                continue
            a, b = tree.span[node]
            scores = product(tree.points[a:b], vector[None, :])[:, 0]
            near = range(b - a) if floor is None else np.flatnonzero(scores >= floor).tolist()
            for i in near:
                if tree.ids[a + i] != own:
                    item = (int(scores[i]), -int(tree.ids[a + i]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
            if len(best) == k and (floor is None or best[0][0] > floor):
                floor = best[0][0]
        out += [(own, -i, s) for s, i in best]
    return out


def top_k(
    rows: DataFrame,
    queries: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
    leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows for each row that ``queries`` (on ``vec_id``) selects."""
    ship_code(rows.sparkSession)
    vectors = staged(valid_vectors(rows, id_col, vector_col), "vectors")
    sizes = F.count("*").alias("n")
    shards = staged(
        vectors.groupBy("dim").agg(sizes).select("dim", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")), "shards"
    )  # one row a vector length
    dealt = vectors.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))

    def build(group: tuple, table: pa.Table) -> pa.Table:
        points = matrix(table.column("v"), group[0].as_py())
        return pa.table({
            "dim": pa.array([group[0].as_py()], pa.int32()), "shard": pa.array([group[1].as_py()], pa.int32()),
            "ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()], "points": [points.astype("<f8").tobytes()],
        })

    points = staged(
        dealt.select("dim", "shard", "vec_id", "v").groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, ids binary, points binary"), "shard-points"
    )
    first = Window.partitionBy("vec_id").orderBy("dim", "v")
    asked = vectors.where(queries).withColumn("copy", F.row_number().over(first)).where("copy = 1").drop("copy")
    counts = asked.groupBy("dim").agg(sizes).select("dim", F.ceil(F.col("n") / query_block).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int")
    asked = staged(asked.join(counts, "dim").withColumn("shard", block), "queries")
    blocks = staged(
        asked.select("dim", "shard", "vec_id", "v").groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, ids binary, points binary")
        .select("dim", F.col("shard").alias("block"), F.col("ids").alias("query_ids"), F.col("points").alias("queries")),
        "query-blocks",
    )

    def searched(batches):
        tree = built = None  # rows of one shard follow one another
        for batch in batches:
            for r in range(batch.num_rows):
                dim, ids, points, query_ids, asked, least = (batch.column(i)[r].as_py() for i in range(6))
                query_ids = np.frombuffer(query_ids, "<i8")
                if built != (dim, ids):
                    n = len(ids) // 8
                    tree, built = Tree(np.frombuffer(points, "<f8").reshape(n, dim), np.frombuffer(ids, "<i8"), leaf), (dim, ids)
                known = {x["query_id"]: x["least"] for x in least or ()}
                found = search(
                    tree, query_ids, np.frombuffer(asked, "<f8").reshape(len(query_ids), dim), [known.get(q) for q in query_ids.tolist()], k
                )
                columns = list(zip(*found, strict=True)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    result = "query_id long, vec_id long, score long"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    paired = blocks.join(shards, "dim").withColumn("home", F.pmod("block", "shards"))
    columns = ["dim", "ids", "points", "query_ids", "queries"]
    at_home = paired.withColumn("shard", F.col("home")).join(points, ["dim", "shard"])
    home = staged(
        at_home.select(*columns, F.lit(None).cast("array<struct<query_id:long,least:long>>").alias("least")).mapInArrow(searched, result), "home"
    )
    kth = home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    least = (
        kth.join(asked.select(F.col("vec_id").alias("query_id"), "dim", F.col("shard").alias("block")), "query_id")
        .groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "least")).alias("least"))  # a block's queries
    )
    elsewhere = (
        paired.join(least, ["dim", "block"], "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard != home").join(points, ["dim", "shard"])
    )
    others = elsewhere.select(*columns, "least").mapInArrow(searched, result)
    return (
        home.unionByName(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def sql(divisor: int, k: int = K) -> str:
    """Brute force over ``embeddings`` in DuckDB SQL; queries are the ids divisible by ``divisor``."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % {divisor} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""
