"""Spelling variants: words one insertion, deletion or replacement apart, each led to its common form.

Words are arranged by a frequency vector, the counts of their letters in ``GROUPS`` groups
(balanced by how often the letters occur). One replaced letter moves at most one count from
a group to another, one inserted letter adds one to a group: between near words the vectors
differ by a surplus and a deficit of one each at most. In a trie over the successive counts
a depth-first search therefore goes from a node to the child with the word's own count, or
spends its surplus on the next higher or its deficit on the next lower one; the words at the
leaves that it reaches are verified letter by letter.

Each pair is searched from one side alone: from the word whose vector is smaller at the first
difference (there the surplus comes first), from the shorter word, or, with equal vectors,
from the word that comes first in code-point order.

The trie is cut into shards at a depth that the data choose: the least one at which no
shard has more than ``SHARD_WORDS`` words. A word is sent to the shards that its budget can
reach, 1 + p + p(p - 1)/2 of them at depth p at most. If even whole vectors are shared by more
words, their shards are cut into blocks of words and of searching words, and every block
meets every other, so no pair is lost and no task gets more than two blocks.

Roots follow the forms by pointer doubling; a form is several times as frequent as its word,
so chains are short. Everything but the letters' groups and the depth stays distributed: Spark
takes a stored table to be as large as its compressed file, also behind an explode, and would
send it whole through the driver, so joins with such tables ask for a sort-merge join.

Null texts have no words; of null ids no letter is left out; repeated ids and rows count again;
an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import id_and_text, ship_code, slices, staged, words_of
from playpulse.llm.crc_sql import crc32_sql

LETTERS = "a-zÀ-ÿ"  # after A-Z are lower-cased
GROUPS = 12
SHARD_WORDS = 4_000
LEAF_PAIRS = 512  # pairs of searching and stored words that are compared without going deeper
FLUSH_PAIRS = 1 << 20
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5


def slip(doc_id: int, words: list[bytes], divisor: int) -> list[tuple[int, str]]:
    """(place in ``words``, word without one letter) of the words whose hash with the id ``divisor`` divides."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    hashes = [zlib.crc32(word, seed) for word in words]
    out = []
    for i in (i for i, h in enumerate(hashes) if h % divisor == 0):
        word = words[i].decode()
        at = hashes[i] % len(word)
        out.append((i, word[:at] + word[at + 1 :]))
    return out


def runs_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lower-cased runs of letters, and the (text, run, times) of each text's distinct runs."""
    words, starts = words_of(texts)
    tokens = pc.ascii_lower(words.dictionary)
    lists = pc.split_pattern_regex(tokens, f"[^{LETTERS}]+")
    parts, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    full = pc.not_equal(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False)
    parts, offsets = parts.filter(pa.array(full)).dictionary_encode(), np.concatenate(([0], np.cumsum(full)))[offsets]
    n = max(len(tokens), 1)
    of_text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pair, times = np.unique(of_text * n + words.indices.to_numpy().astype(np.int64), return_counts=True)
    text, token = pair // n, pair % n
    size = offsets[token + 1] - offsets[token]
    at = np.repeat(offsets[token] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    codes = parts.indices.to_numpy().astype(np.int64)[at]
    m = max(len(parts.dictionary), 1)
    both, place = np.unique(np.repeat(text, size) * m + codes, return_inverse=True)
    return parts.dictionary, both // m, both % m, np.bincount(place, weights=np.repeat(times, size), minlength=len(both)).astype(np.int64)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, slip_divisor: int | None = None) -> DataFrame:
    """(word, n) of all runs of letters with ``least_length`` letters or more.

    With ``slip_divisor`` a document leaves a letter out of those of its runs whose CRC-32 with
    the document's id it divides: misspellings, the same in every run of the program.
    """
    ship_code(docs.sparkSession)

    def count(batches):
        for part in slices(batches, "text"):
            runs, text, run, times = runs_of(part.column(1))
            if not len(runs):
                continue
            total = np.bincount(run, weights=times, minlength=len(runs)).astype(np.int64)
            changed: Counter[str] = Counter()
            if slip_divisor:
                names, ids = np.array(runs.cast(pa.binary()).to_pylist(), object), part.column(0).to_pylist()
                ends = np.searchsorted(text, np.arange(len(ids) + 1))
                for i, doc_id in enumerate(ids):
                    a, b = ends[i], ends[i + 1]
                    for k, word in slip(doc_id, names[run[a:b]].tolist(), slip_divisor) if doc_id is not None else ():
                        changed[word] += int(times[a + k])
                        total[run[a + k]] -= times[a + k]
            keep = (total > 0) & (pc.utf8_length(runs).to_numpy(zero_copy_only=False) >= least_length)
            more = [(w, n) for w, n in changed.items() if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([runs.filter(pa.array(keep)).cast(pa.string()), pa.array([w for w, _ in more], pa.string())]),
                    pa.array(np.concatenate((total[keep], np.array([n for _, n in more], np.int64)))),
                ],
                ["word", "n"],
            )

    texts = id_and_text(docs, id_col, text_col)
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """Letters dealt to groups of about equal frequency (as many rows as there are letters)."""
    letters = words.select(F.explode(F.split("word", "")).alias("ch")).where("ch != ''").groupBy("ch").count().collect()
    out, load = [""] * groups, [0] * groups
    for r in sorted(letters, key=lambda r: (-r["count"], r["ch"])):
        least = load.index(min(load))
        out[least] += r["ch"]
        load[least] += r["count"]
    return out


def vector(word: Column, groups: list[str]) -> Column:
    left = [F.length(F.translate(word, g, "")) if g else F.length(word) for g in groups]
    return F.array(*[(F.length(word) - x).cast("int") for x in left])


def reachable(vec: Column, depth: int) -> Column:
    """All beginnings of ``depth`` counts that a surplus of one and, behind it, a deficit of one make of a vector."""
    moves = [{}, *[{i: 1} for i in range(depth)], *[{i: 1, j: -1} for i in range(depth) for j in range(i + 1, depth)]]
    cell = lambda i, d: (F.get(vec, F.lit(i)) + F.lit(d)).cast("int")
    made = F.array(*[F.array(*[cell(i, m.get(i, 0)) for i in range(depth)]) for m in moves])
    return F.filter(made, lambda x: F.forall(x, lambda c: c >= 0))


class Trie:
    """The trie of one shard's words: rows sorted by vector, a node is a range of them."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        self.vectors = vectors[self.order]

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, word rows) at the leaves that the searches reach; all queries go down together."""
        levels = self.vectors.shape[1]
        stack = [(0, 0, len(self.vectors), np.arange(len(queries)), np.zeros(len(queries), np.int8))]
        while stack:
            depth, lo, hi, rows, spent = stack.pop()
            if depth == levels or (hi - lo) * len(rows) <= LEAF_PAIRS:
                yield np.repeat(rows, hi - lo), np.tile(self.order[lo:hi], len(rows))
                continue
            counts = self.vectors[lo:hi, depth]
            cuts = np.flatnonzero(np.diff(counts)) + 1
            own = queries[rows, depth]
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), hi - lo], strict=True):
                more = int(counts[a]) - own
                fits = (more == 0) | ((more == 1) & (spent == 0)) | ((more == -1) & (spent == 1))
                if fits.any():
                    stack.append((depth + 1, lo + a, lo + b, rows[fits], spent[fits] + np.abs(more[fits]).astype(np.int8)))


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points, those of ``b`` as long or one longer, differ by exactly one letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    head = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


class Verifier:
    """Verifies pairs of words letter by letter, a bounded number at once."""

    def __init__(self, words: list[str], others: list[str]):
        self.sides = [self._by_length(words), self._by_length(others)]

    @staticmethod
    def _by_length(words: list[str]):
        length = np.array([len(w) for w in words], np.int64)
        place, table = np.zeros(len(words), np.int64), {}
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            place[at] = np.arange(len(at))
            table[int(n)] = np.array([words[i] for i in at]).view(np.uint32).reshape(len(at), int(n))
        return length, place, table

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        (length, place, table), (other, spot, others) = self.sides
        out = np.zeros(len(i), bool)
        for n in np.unique(length[i]).tolist():
            for m in (n, n + 1):
                at = np.flatnonzero((length[i] == n) & (other[j] == m))
                step = max(1, (1 << 22) // n)
                for k in range(0, len(at), step):
                    part = at[k : k + step]
                    out[part] = one_apart(table[n][place[i[part]]], others[m][spot[j[part]]])
        return out


def pairs_of_shard(rows: pa.Table) -> pa.Table:
    """(word, near, near_n) both ways of every pair of near words that this shard is to find."""
    searching = pc.equal(rows.column("role"), 0)
    sides = []
    for part in (rows.filter(searching), rows.filter(pc.invert(searching))):
        flat = part.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        vectors = flat.reshape(part.num_rows, len(flat) // max(1, part.num_rows))  # a block may have none on one side
        sides.append((part.column("word").to_pylist(), part.column("n").to_numpy(), vectors))
    (words, n, vec), (others, other_n, other_vec) = sides
    found = []
    if words and others:
        verifier = Verifier(words, others)
        rank = np.unique(np.array([*words, *others], object), return_inverse=True)[1]
        left, right = rank[: len(words)], rank[len(words) :]

        def verify(i: np.ndarray, j: np.ndarray) -> None:
            more = other_vec[j] - vec[i]
            first = np.take_along_axis(more, (more != 0).argmax(1)[:, None], 1)[:, 0]
            ok = (first > 0) | ((first == 0) & (right[j] > left[i]))
            ok &= (np.maximum(more, 0).sum(1) <= 1) & (np.maximum(-more, 0).sum(1) <= 1)
            i, j = i[ok], j[ok]
            near = verifier.near(i, j)
            found.append((i[near], j[near]))

        waiting, size = [], 0
        for pair in Trie(other_vec).search(vec):
            waiting.append(pair)
            size += len(pair[0])
            if size >= FLUSH_PAIRS:
                verify(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, size = [], 0
        if waiting:
            verify(*map(np.concatenate, zip(*waiting, strict=True)))
    i, j = map(np.concatenate, zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
    a, b = np.array(words, object)[i], np.array(others, object)[j]
    return pa.table({
        "word": pa.array(np.concatenate((a, b)), pa.string()),
        "near": pa.array(np.concatenate((b, a)), pa.string()),
        "near_n": pa.array(np.concatenate((other_n[j], n[i])), pa.int64()),
    })


def near_words(words: DataFrame, groups: int = GROUPS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, near, near_n) of every pair of near words of ``words`` (word, n; stored), both ways."""
    ship_code(words.sparkSession)
    shaped = words.select("word", "n", vector(F.col("word"), letter_groups(words, groups)).alias("vec"))
    vectors = staged(shaped.groupBy("vec").agg(F.count("*").alias("m")), "vectors")
    begins = vectors.select(F.explode(F.sequence(F.lit(1), F.lit(groups))).alias("p"), "vec", "m")
    largest = {
        r["p"]: r["m"]
        for r in begins.groupBy("p", F.slice("vec", F.lit(1), F.col("p")).alias("shard")).agg(F.sum("m").alias("m")).groupBy("p").agg(F.max("m").alias("m")).collect()
    }
    depth = next((p for p in range(1, groups) if largest.get(p, 0) <= shard_words), groups)
    begin, reach = F.slice("vec", 1, depth), F.explode(reachable(F.col("vec"), depth))
    shards = (
        vectors.groupBy(begin.alias("shard")).agg(F.sum("m").alias("stored"))
        .join(vectors.select(reach.alias("shard"), "m").groupBy("shard").agg(F.sum("m").alias("searching")).hint("merge"), "shard")
        .select("shard", *[F.ceil(F.col(c) / F.lit(shard_words)).alias(f"{c}_blocks") for c in ("stored", "searching")])
        .hint("merge")
    )
    block = lambda c: F.pmod(F.xxhash64("word"), F.col(f"{c}_blocks"))
    blocks = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{c}_blocks") - 1))
    stored = shaped.withColumn("shard", begin).join(shards, "shard").select(
        "shard", block("stored").alias("a"), blocks("searching").alias("b"), F.lit(1).alias("role"), "word", "n", "vec"
    )
    searching = shaped.withColumn("shard", reach).join(shards, "shard").select(
        "shard", blocks("stored").alias("a"), block("searching").alias("b"), F.lit(0).alias("role"), "word", "n", "vec"
    )
    return stored.union(searching).groupBy("shard", "a", "b").applyInArrow(pairs_of_shard, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word in ``forms`` (word, form): the last word that the forms lead to."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = staged(at.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return at


def spelling_variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n; no word twice).

    A word's form is the near word with the largest n (of equal ones the first in code-point
    order), if that n is at least ``ratio`` times its own; its root is where forms end.
    """
    words = staged(words.select("word", "n"), "words")
    best = near_words(words, shard_words=shard_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    formed = F.col("near_n") >= ratio * F.col("n")
    known = staged(
        words.join(best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")).hint("merge"), "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")),
        "forms",
    )
    return known.join(roots(known.where("form is not null")).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def sql(divisor: int) -> str:
    """The query over ``documents`` in DuckDB SQL: near words share a word with one letter less."""
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
hashed AS (
  SELECT *, {crc32_sql("doc_id::VARCHAR || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL)),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % {divisor} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
less AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.less = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.less = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
known AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= {RATIO} * w.n THEN near END AS form, CASE WHEN near_n >= {RATIO} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
led AS (
  SELECT word, word AS at, form FROM known
  UNION ALL SELECT led.word, k.word, k.form FROM led JOIN known k ON k.word = led.form)
SELECT k.word, k.form, led.at AS root, k.n, k.n_near, k.form_n FROM known k JOIN led ON led.word = k.word AND led.form IS NULL"""
