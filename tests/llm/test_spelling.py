import random
import re
import zlib
from collections import Counter

import numpy as np

from playpulse.llm import spelling
from playpulse.llm.common import staged
from playpulse.llm.spelling import Trie, count_words, near_words, one_apart, roots, spelling_variants

from . import odd


def brute_words(rows, divisor, least=6):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % divisor == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    best, count = {}, {}
    for w in words:
        others = [v for v in words if near(w, v)]
        count[w] = len(others)
        if others:
            top = min(others, key=lambda v: (-words[v], v))
            if words[top] >= ratio * words[w]:
                best[w] = top
    out = []
    for w, n in words.items():
        root = w
        while root in best:
            root = best[root]
        out.append((w, best.get(w), root, n, count[w], words.get(best.get(w))))
    return sorted(out, key=repr)


def some_words(seed, n, letters="abcé"):
    r = random.Random(seed)
    return {"".join(r.choices(letters, k=r.randint(6, 9))): r.choice([5, 6, 30, 200, 5000, 5000]) for _ in range(n)}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def result(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def test_variants_against_brute_force(spark):
    words = some_words(1, 700)
    assert result(spelling_variants(frame(spark, words))) == brute_variants(words)


def test_variants_in_many_blocks(spark):
    """Shards of so few words that the whole vector is the shard and is cut into blocks."""
    words = some_words(2, 300, "ab")
    assert result(spelling_variants(frame(spark, words), shard_words=3)) == brute_variants(words)


def test_pairs_come_once_each_way(spark):
    words = some_words(3, 400, "abé")
    got = Counter((r.word, r.near, r.near_n) for r in near_words(frame(spark, words), shard_words=40).collect())
    assert got == Counter((a, b, words[b]) for a in words for b in words if near(a, b))


def test_no_table_goes_through_the_driver_by_the_size_of_its_file(spark, monkeypatch):
    """Rows behind an explode are taken to be as few bytes as the file: too low, they mustn't be broadcast."""
    words = frame(spark, some_words(5, 200))
    planned = [near_words(staged(words, "words"))]
    monkeypatch.setattr(spelling, "staged", lambda df, name: planned.append(df) or staged(df, name))
    planned.append(spelling_variants(words))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in planned]
    assert sum("SortMergeJoin" in p for p in plans) > 3
    assert not [p for p in plans if "Broadcast" in p]


def test_words_of_odd_texts(spark):
    rows = [*odd.texts(), (77, "don't STOP-stop Éclair éclair ÀÖØß × a÷b " * 9), (78, "übermäßig " * 300)]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, word string, n int")
    for divisor in (3, 199):
        got = {r.word: r.n for r in count_words(df, slip_divisor=divisor).collect()}
        assert got == brute_words(rows, divisor)
    plain = {r.word: r.n for r in count_words(df).collect()}
    assert plain == brute_words([(None, t) for _, t in rows], 1)
    assert count_words(odd.empty(spark)).count() == 0
    assert spelling_variants(count_words(odd.empty(spark))).count() == 0


def test_very_long_words(spark):
    long = "ab" * 40_000
    words = {long: 5, long[:-1]: 500, "x" + long[1:]: 5, "kurzes": 7}
    assert result(spelling_variants(frame(spark, words))) == brute_variants(words)


def test_long_chains_end_at_their_root(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)]
    got = {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w040" for w, _ in chain}


def test_the_trie_opens_few_leaves():
    r = np.random.default_rng(4)
    vectors = r.integers(0, 3, (20_000, 12))
    reached = sum(len(i) for i, _ in Trie(vectors).search(vectors[:200]))
    assert reached < 0.03 * 200 * 20_000  # leaves hold up to LEAF_PAIRS pairs that are compared at once
    all_pairs = {(i, j) for a, b in Trie(vectors).search(vectors[:50]) for i, j in zip(a.tolist(), b.tolist())}
    assert {(i, i) for i in range(50)} <= all_pairs


def test_one_apart():
    a = np.array([[1, 2, 3], [1, 2, 3], [1, 1, 1]])
    assert one_apart(a, np.array([[1, 2, 4], [1, 2, 3], [2, 2, 1]])).tolist() == [True, False, False]
    assert one_apart(a, np.array([[9, 1, 2, 3], [1, 2, 3, 3], [1, 2, 2, 1]])).tolist() == [True, True, False]
