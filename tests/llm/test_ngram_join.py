import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa

from playpulse.llm import ngram_join
from playpulse.llm.components import components
from playpulse.llm.ngram_join import FILTER_BITS, jaccard_components, overlap_bound, packed_grams, packed_steps, unpacked_grams, unpacked_steps
from playpulse.llm.shingles import shingle_sets

from . import odd


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """The component of each row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(b)] = find(a)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            groups[find(i)] = min(groups.get(find(i), doc), doc)
    return Counter((d, len(sets[i]), groups.get(find(i))) for i, (d, _) in enumerate(rows))


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_shingle_sets():
    texts = [t for _, t in odd.texts()] + ["a b c d", "a b c d e", "A b C d e", None]
    hashes, begins = shingle_sets(pa.array(texts, pa.string()))
    sizes = np.diff(begins).tolist()
    assert sizes == [len(shingles(t)) for t in texts]
    assert hashes[begins[-4]] == hashes[begins[-3]]
    for a, b in zip(begins[:-1], begins[1:]):
        assert (np.diff(hashes[a:b].astype(object)) > 0).all()


def test_packing_of_blocks():
    for steps in ([0, 0, 1, 5, 300], [3], [0, 70_000 % 65_536]):
        x = np.cumsum(steps)
        assert unpacked_steps(packed_steps(x), len(x)).tolist() == x.tolist()
    grams = np.array([0, 65_535, 65_536, (1 << 24) - 1])
    assert unpacked_grams(*packed_grams(grams)).tolist() == grams.tolist()


def test_suffix_filter_never_undercounts():
    r = np.random.default_rng(1)
    for _ in range(50):
        pool = r.integers(0, 2**64, 300, dtype=np.uint64)
        x, y = np.unique(r.choice(pool, 150)), np.unique(r.choice(pool, 150))
        assert overlap_bound(x, y) >= len(np.intersect1d(x, y))


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (5, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark):
    assert found(jaccard_components(odd.documents(spark))) == brute(odd.texts())
    assert jaccard_components(odd.empty(spark)).count() == 0


def test_first_slot_of_the_filter(spark):
    """xxhash64 of this id is a multiple of FILTER_BITS."""
    words = odd.prose(7, 60).split()
    rows = [(25317696, " ".join(words)), (25317697, " ".join([*words[:30], "changed", *words[31:]])), (25317698, odd.prose(8, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.where(f"pmod(xxhash64(doc_id), {FILTER_BITS}) = 0").count() == 1
    assert found(jaccard_components(docs)) == brute(rows)
    assert len({c for _, _, c in found(jaccard_components(docs))}) == 2


def test_against_all_pairs(spark):
    """Copies, near copies in chains, and a passage that many documents share."""
    r, rows = random.Random(3), []
    passage = odd.prose(99, 40)
    for g in range(25):
        words = odd.prose(1000 + g, r.choice([6, 12, 40, 90])).split()
        for _ in range(r.choice([1, 2, 5, 12])):
            if r.random() < 0.8:
                words = list(words)
                words[r.randrange(len(words))] = odd.prose(r.randrange(10**6), 1)
            rows.append((len(rows), " ".join(words) + (" " + passage if r.random() < 0.3 else "")))
    rows += [(len(rows) + i, rows[0][1]) for i in range(40)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(jaccard_components(docs)) == brute(rows)


def test_ranges_follow_the_data_and_not_the_session(spark, monkeypatch):
    """A hash range's group stays near its bound, whatever the number of shuffle partitions is."""
    docs = spark.createDataFrame([(i, odd.prose(i, 400)) for i in range(300)], "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "RANGE_SHINGLES", 256)
    asked = []
    prefixes = ngram_join.prefixes
    monkeypatch.setattr(ngram_join, "prefixes", lambda d, w, p, ranges, counts: asked.append((ranges, counts.max())) or prefixes(d, w, p, ranges, counts))
    results = []
    for partitions in ("4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            results.append(sorted(map(tuple, ngram_join.jaccard_components(docs).select("doc_id", "component_id").collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    total = 300 * 396
    assert [r for r, _ in asked] == [512, 512] and total / 512 <= 256
    assert results[0] == results[1] and len(results[0]) == 300
