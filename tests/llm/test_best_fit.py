import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from playpulse.llm.best_fit import CAPACITY, RoomTree, best_fit, plan
from playpulse.llm.tokens import load

from . import odd

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(lengths, capacity):
    """The rooms left by best-fit decreasing, piece after piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        open_ = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if open_:
            rooms[min(open_)[1]] -= n
        else:
            rooms.append(capacity - n)
    return rooms


def filled(runs):
    """What each sequence holds, by walking the runs; offsets must follow one another."""
    used = Counter()
    for length, _, many, per, first, at in runs:
        for i in range(many):
            s = first + i // per
            assert used[s] == at + i % per * length
            used[s] += length
    return used


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_best_fit_piece_by_piece(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 64, 100])
    lengths = [r.randint(1, r.choice([capacity, max(1, capacity // 3)])) for _ in range(r.randint(0, 300))]
    used = filled(plan(Counter(lengths), capacity))
    assert sorted(capacity - n for n in used.values()) == sorted(brute(lengths, capacity))
    assert sorted(used) == list(range(len(used)))


def test_plan_of_very_many_pieces_stays_small():
    counts = {n: 10**12 + n for n in range(1, 4097)}
    runs = plan(counts, 4096)
    assert len(runs) < 20_000
    placed = Counter()
    for length, rank, many, *_ in runs:
        assert rank == placed[length]
        placed[length] += many
    assert placed == counts
    sequences = max(first + -(-many // per) for _, _, many, per, first, _ in runs)
    assert sequences <= 1.001 * sum(n * c for n, c in counts.items()) / 4096


def test_the_tightest_room_is_found():
    tree = RoomTree(100)
    assert tree.tightest(1) is None
    for room in (7, 40, 41, 99):
        tree.add(room, room, 1)
    assert [tree.tightest(n) for n in (1, 7, 8, 41, 42, 100)] == [7, 7, 40, 41, 99, None]
    tree.take(41)
    assert tree.tightest(41) == 99


def test_round_trip(spark):
    rows = best_fit(odd.documents(spark), PATH, capacity=512).collect()
    ids = defaultdict(list)
    for i, t in odd.texts():
        ids[i].append([*load(PATH)([t or ""])[0], 1])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter(
        (i, p, a, len(x[a : a + 512]), zlib.crc32(np.asarray(x[a : a + 512], "<u4").tobytes()))
        for i, xs in ids.items() for x in xs for p, a in enumerate(range(0, len(x), 512))
    )
    assert found == want
    assert sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) == len(brute([r.length for r in rows], 512))
    assert best_fit(odd.empty(spark), PATH).count() == 0


def test_one_document_in_most_rows(spark):
    docs = spark.createDataFrame([(5, "the same text")] * 3000 + [(i, odd.prose(i, 30)) for i in range(20)], "doc_id long, text string")
    rows = best_fit(docs.repartition(7), PATH).collect()
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert len(rows) == 3020 and max(used.values()) <= CAPACITY
    assert len(used) == -(-sum(used.values()) // CAPACITY)
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3020
