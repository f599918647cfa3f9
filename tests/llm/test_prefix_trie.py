import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from playpulse.llm.double_array import ROOT, DoubleArray
from playpulse.llm.prefix_trie import hashed_ends, prefix_trie, rebuilt, subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, words int"


def conversations_of(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out[c].append(((turn is not None, turn or 0), role, key, text))
    return {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in out.items()}


def brute(rows, rebuild=False):
    convs = conversations_of(rows)
    if rebuild:
        heads = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        first = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
        convs = {c: convs.get(first(c), [])[: heads[c]] + turns[heads[c] :] for c, turns in convs.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        words = len([w for w in (node[-1][1].translate({i: " " for i in range(9, 14)}).split(" ") if node else []) if w])
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(cs) - 1) * words
    return sorted(
        (min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), len(kids[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, cs in members.items()
    )


def result(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in df.dtypes[:-1]} == {"bigint"}
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def talk(seed, n, texts=3, longest=6):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot"]), " ".join(r.choices(["a", "b c", ""][:texts], k=1))) for c in range(n) for t in range(r.randint(1, longest))]


ODD = [
    (1, None, "user", "first\tof all"), (1, 0, None, "x"), (1, 1, "user", None), (1, 1, "user", None), (1, 1, "bot", "tie"),
    (None, 0, "user", "nobody"), (2, 5, "user", "late start"), (-5, 0, "user", "negative"), (-20, 0, "user", "negative"), (3, 0, "", ""), (3, 0, "", ""),
    *[(20, t, "user", f"turn {t} " * 5) for t in range(150)], *[(41, t, "user", f"turn {t} " * 5) for t in range(140)], *[(44, t, "user", f"turn {t} " * 5) for t in range(130)],
    (60, 0, "user", "word " * 50_000), (61, 0, "user", "word " * 50_000), (62, 0, "x", "word"),
]


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("shard_segments", [5000, 7])
def test_nodes_against_brute_force(spark, rebuild, shard_segments):
    rows = talk(1, 150) + [(c + 200, *rest) for c, *rest in ODD if c is not None] + [r for r in ODD if r[0] is None]
    got = prefix_trie(frame(spark, rows), shape=rebuilt if rebuild else None, shard_segments=shard_segments)
    assert result(got) == brute(rows, rebuild)


def test_odd_rows(spark):
    assert result(prefix_trie(frame(spark, ODD), shape=rebuilt)) == brute(ODD, True)
    assert prefix_trie(frame(spark, ODD).where("false"), shape=rebuilt).count() == 0


def test_one_conversation_in_most_rows(spark, monkeypatch):
    """One long conversation, over many slabs, one that many share, and a first turn that most begin with."""
    monkeypatch.setattr("playpulse.llm.prefix_trie.SLAB", 16)
    rows = [(7, t, "user", f"step {t}") for t in range(200)]
    rows += [(c, t, "user", f"hello {t}") for c in range(100, 400) for t in range(3)]
    rows += [(c, t, "user", "hello 0" if t == 0 else f"{c} {t}") for c in range(400, 700) for t in range(3)]
    assert result(prefix_trie(frame(spark, rows), shard_segments=20)) == brute(rows)


def test_double_array_holds_its_sequences_and_no_others():
    r = random.Random(3)
    sequences = sorted({tuple(r.choices(range(1, 9), k=r.randint(0, 5))) for _ in range(400)})
    trie = DoubleArray(sequences)
    states = {}
    for s in sequences:
        way = list(trie.walk(s))
        assert len(way) == len(s)
        for d, state in enumerate(way):
            assert states.setdefault(state, s[: d + 1]) == s[: d + 1]
    assert len(states) == len({s[:d] for s in sequences for d in range(1, len(s) + 1)}) and ROOT not in states
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    for p in prefixes:
        state = [ROOT, *trie.walk(p)][-1]
        assert {c for c in range(1, 12) if trie.child(state, c) is not None} == {c for c in range(1, 12) if (*p, c) in prefixes}
    assert len(trie.check) < 4 * len(states) + 20


def test_ends_of_one_node_meet_as_joined_ranges(spark, monkeypatch):
    monkeypatch.setattr("playpulse.llm.prefix_trie.CHUNK_IDS", 10)
    ids = list(range(-5, 500))
    df = spark.createDataFrame([(bytearray(b"k"), i) for i in ids] + [(bytearray(b"j"), 3)], "key binary, conv_id long")
    got = {bytes(r.key): r.ends_sha256 for r in hashed_ends(df).collect()}
    assert got == {b"k": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"j": hashlib.sha256(b"3").hexdigest()}


def test_sums_climb_a_chain_of_chains(spark):
    """Every conversation hangs on the one before it, below the long chain of the first."""
    rows = [(0, d, None if d == 0 else 0, 1) for d in range(2500)] + [(c, c, c - 1, 1) for c in range(1, 12)]
    df = spark.createDataFrame(rows, "conv_id long, depth long, parent long, v long")
    got = {(r.conv_id, r.depth): r.v for r in subtree_sums(df, ["v"]).collect()}
    assert got == {**{(0, d): 2500 - d + (11 if d == 0 else 0) for d in range(2500)}, **{(c, c): 12 - c for c in range(1, 12)}}
