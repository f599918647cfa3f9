"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

Weights are whole numbers that add up to D. A source of weight q owns the fraction q / D of
the slots, one block of documents a slot. Its block i is released at floor(i D / q) and due by
ceil((i + 1) D / q); in every slot the released block with the earliest deadline goes first.
As the fractions add up to one, all deadlines are met, so while every source still has blocks
each is less than one block away from its share at any time.

The schedule repeats after D slots, so one round of D slots is enough (a fold over D, in SQL):
block i of a source takes slot (i div q) D + the slot of block i mod q. Documents are numbered
within their source in the order of md5(id): per bucket of the hash, then by the counts of the
buckets before, so a source with a third of all rows is numbered by many tasks. Every row gets
its place; when a source runs dry its slots are left out and the others keep their proportions.

Sources without a weight and null sources share the weight of ``OTHER``. Null ids sort by the
hash of the empty text; repeated ids and rows get a place each, ties in any order; an empty
table gives no row; further columns are ignored (``in_mix_order`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm.common import free_name

OTHER = "*"
#: Target shares in percent.
RECIPE = {"src0": 15} | {f"src{i}": 6 if i < 6 else 4 if i < 13 else 3 for i in range(1, 20)} | {OTHER: 6}
BLOCK = 16  # documents
HASH_DIGITS = 3  # of md5, so 4096 buckets a source


def schedule(weights: dict[str, int]) -> str:
    """SQL for the source numbers of the slots 0 .. D - 1 as one array."""
    q, total = ", ".join(map(str, weights.values())), sum(weights.values())
    due = f"struct(((a.done[s] + 1) * {total} + q[s] - 1) div q[s] AS due, s AS s)"
    released = f"a.done[s] < q[s] AND a.done[s] * {total} div q[s] <= t"
    pick = f"array_min(transform(filter(sequence(0, {len(weights) - 1}), s -> {released}), s -> {due})).s".replace("q[s]", f"array({q})[s]")
    return (
        f"aggregate(sequence(0, {total - 1}), named_struct('done', array_repeat(0, {len(weights)}), 'out', cast(array() AS array<int>)),"
        f" (a, t) -> named_struct('done', transform(a.done, (c, k) -> c + if(k = {pick}, 1, 0)), 'out', concat(a.out, array({pick}))),"
        " a -> a.out)"
    )


def placed(docs: DataFrame, weights: dict[str, int], block: int, id_col: str, source_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with further columns under free names: source number, block, slot, position."""
    if OTHER not in weights or min(weights.values()) < 1:
        raise ValueError(f"weights are whole numbers from 1, with one for {OTHER!r}")
    n = {k: free_name(docs, f"mix_{k}") for k in ("s", "bucket", "hash", "own", "first", "block", "turn", "slot", "position", "quota", "at")}
    names, total = list(weights), sum(weights.values())
    number = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(names) if k != OTHER for x in (k, i)]), F.col(f"`{source_col}`").cast("string"))
        if len(names) > 1 else F.lit(None).cast("int"),
        F.lit(names.index(OTHER)),
    )
    hashed = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    rows = (
        docs.withColumn(n["s"], number).withColumn(n["hash"], hashed)
        .withColumn(n["bucket"], F.substring(n["hash"], 1, HASH_DIGITS))
    )
    before = Window.partitionBy(n["s"]).orderBy(n["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(n["s"], n["bucket"]).agg(F.count("*").alias(n["own"]))
    counts = counts.withColumn(n["first"], F.coalesce(F.sum(n["own"]).over(before), F.lit(0))).drop(n["own"])
    own = Window.partitionBy(n["s"], n["bucket"]).orderBy(n["hash"], F.col(f"`{id_col}`"))
    round_ = (
        docs.sparkSession.range(1).select(F.posexplode(F.expr(schedule(weights))).alias(n["at"], n["s"]))
        .withColumn(n["turn"], F.row_number().over(Window.partitionBy(n["s"]).orderBy(n["at"])) - 1)
    )
    rank = F.col(n["own"]) + F.col(n["first"])
    out = (
        rows.withColumn(n["own"], F.row_number().over(own) - 1)
        .join(counts, [n["s"], n["bucket"]])
        .withColumn(n["quota"], F.get(F.array(*map(F.lit, weights.values())), F.col(n["s"])))
        .withColumn(n["block"], F.floor(rank / block))
        .withColumn(n["turn"], (F.col(n["block"]) % F.col(n["quota"])).cast("int"))
        .join(F.broadcast(round_), [n["s"], n["turn"]])  # D rows, a parameter
        .withColumn(n["slot"], F.floor(F.col(n["block"]) / F.col(n["quota"])) * total + F.col(n["at"]))
        .withColumn(n["position"], F.col(n["slot"]) * block + rank % block)
    )
    return out, n


def mix_sources(
    docs: DataFrame, weights: dict[str, int] = RECIPE, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """(doc_id, source, mix_source, block, slot, position) of every row; ``position`` orders the mix."""
    rows, n = placed(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source")), weights, block, "doc_id", "source")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.get(F.array(*map(F.lit, weights)), F.col(n["s"])).alias("mix_source"),
        *[F.col(n[k]).alias(k) for k in ("block", "slot", "position")],
    )


def in_mix_order(
    docs: DataFrame, weights: dict[str, int] = RECIPE, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """All rows and columns of ``docs``, sorted into the mix."""
    rows, n = placed(docs, weights, block, id_col, source_col)
    return rows.orderBy(n["position"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def sql(weights: dict[str, int] = RECIPE, block: int = BLOCK) -> str:
    """``mix_sources`` over ``documents`` in DuckDB SQL."""
    names, q, total, n = list(weights), list(weights.values()), sum(weights.values()), len(weights)
    named = ", ".join(f"('{k}', {i + 1})" for i, k in enumerate(names) if k != OTHER)
    return f"""
WITH RECURSIVE quota AS (SELECT {q} AS q, {names} AS name),
state AS (
  SELECT 0 AS t, list_transform(range({n}), lambda x: 0) AS done, 0 AS pick
  UNION ALL
  SELECT t + 1, list_transform(range(1, {n + 1}), lambda k: done[k] + (k = p)::INT), p FROM (
    SELECT t, done, (list_min(list_transform(
      list_filter(range(1, {n + 1}), lambda k: done[k] < q[k] AND done[k] * {total} // q[k] <= t),
      lambda k: ((done[k] + 1) * {total} + q[k] - 1) // q[k] * 1000 + k)) % 1000)::INT AS p
    FROM state, quota WHERE t < {total})),
round AS (SELECT pick AS s, t - 1 AS place, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM state WHERE t > 0),
numbered AS (SELECT * FROM (VALUES {named}) AS v(name, s)),
ranked AS (
  SELECT doc_id, source, coalesce(v.s, {names.index(OTHER) + 1}) AS s,
         row_number() OVER (PARTITION BY coalesce(v.s, {names.index(OTHER) + 1}) ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS r
  FROM documents LEFT JOIN numbered v ON v.name = source),
blocks AS (SELECT *, r // {block} AS block FROM ranked)
SELECT doc_id, source, name[b.s] AS mix_source, block::BIGINT AS block,
       (block // q[b.s] * {total} + place)::BIGINT AS slot, ((block // q[b.s] * {total} + place) * {block} + r % {block})::BIGINT AS position
FROM blocks b CROSS JOIN quota JOIN round ON round.s = b.s AND round.turn = block % q[b.s]"""
