"""Sets of hashed word shingles, as flat arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from playpulse.llm.common import mixed, word_hashes, words_of

WORDS = 5
BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin (one entry more).

    A-Z count as a-z; a text with fewer than ``words`` words has its whole sequence as one
    shingle, a text without words has none.
    """
    found, starts = words_of(pc.ascii_lower(texts))
    h = word_hashes(found)
    n = np.diff(starts)
    made = np.maximum(n - words + 1, (n > 0).astype(np.int64))
    begins = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(int(begins[-1]), np.uint64)
    if len(h) >= words:
        rolled = h[: len(h) - words + 1].copy()
        for k in range(1, words):
            rolled = rolled * BASE + h[k : len(h) - words + 1 + k]
        full = np.flatnonzero(n >= words)
        inside = np.zeros(len(rolled) + 1, np.int64)
        np.add.at(inside, starts[full], 1)
        np.add.at(inside, starts[full] + made[full], -1)
        out[np.repeat(n >= words, made)] = mixed(rolled[np.cumsum(inside[:-1]) > 0])
    for i in np.flatnonzero((n > 0) & (n < words)):
        few = np.uint64(n[i])
        with np.errstate(over="ignore"):
            for x in h[starts[i] : starts[i + 1]]:
                few = few * BASE + x
        out[begins[i]] = mixed(np.array([few], np.uint64))[0]
    edges = begins.tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), bool)
    if len(out):
        new[1:] = out[1:] != out[:-1]
        new[begins[:-1][made > 0]] = True
    before = np.concatenate(([0], np.cumsum(new)))
    return out[new], before[begins]


def set_keys(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each whole set: its key and a check against equal keys (0 for an empty set)."""
    sums = []
    for salt in (np.uint64(0), BASE):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ salt), dtype=np.uint64)))
        sums.append(mixed(total[begins[1:]] - total[begins[:-1]]).view(np.int64))
    return sums[0], sums[1]
