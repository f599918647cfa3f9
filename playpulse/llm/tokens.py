"""Token ids and token counts by a public tokenizer, through distinct words.

``word_bpe_49k.json`` drops white space and none of its patterns crosses it, so the ids of a
text are the ids of its words one after another: ASCII white space is a safe boundary for
long texts. So is the place between a letter and a full stop or comma that ends a word, and
lower and upper case Latin letters give the same ids. A worker encodes each distinct word of
a slice once, in one batch call, and remembers words up to a fixed number; tokenizers whose
pieces depend on case or on the white space around them are used on whole texts instead
(``by_word=False``; ``splits_safely`` tells by trying).
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from playpulse.llm.common import words_of

REMEMBERED = 600_000  # words a worker keeps between slices
#: Words of Latin letters that are their own normal form, with one full stop or comma at most.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+[.,]?$"
LONG_WORD = 256  # bytes; longer words are encoded each time, never kept


@lru_cache(maxsize=2)
def load(path: str):
    """A function from a list of texts to a list of id lists, without added special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core belongs to this task
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: model.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


#: Texts whose ids change if their words' ids depend on white space, case, marks or neighbours.
PROBES = [
    "a b", "A b. C, d", "two  spaces\nline\tx", " before and after ", "ÉCOLE École école", "don't stop", "1 2 34", "The the THE", "x.y z,", "end.\n\nNew", "word" * 9 + " w",
]


@lru_cache(maxsize=8)
def splits_safely(path: str) -> bool:
    """Whether the ids of a text are those of its words, case and final marks apart, one after another."""
    probes = pa.array(PROBES)
    return token_bytes(probes, path, True) == token_bytes(probes, path, False)


class WordCache:
    """Word to what ``of_ids`` makes of its ids; forgets everything when it is full."""

    def __init__(self, path: str, of_ids):
        self.path, self.of_ids, self.known = path, of_ids, {}

    def values(self, words: list[str]) -> list:
        known = self.known
        found = [known.get(w) for w in words]
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            encode = load(self.path)
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
            for a in range(0, len(missing), 50_000):
                part = missing[a : a + 50_000]
                for i, ids in zip(part, encode([words[i] for i in part]), strict=True):
                    v = found[i] = self.of_ids(ids)
                    if len(words[i]) <= LONG_WORD and len(known) < REMEMBERED:
                        known[words[i]] = v
        return found

    def parts(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of distinct words: the values without a final mark, and the values of the marks (0 where none)."""
        plain = pc.match_substring_regex(words, PLAIN)
        stems = pc.if_else(plain, pc.utf8_lower(pc.ascii_rtrim(words, characters=".,")), words).dictionary_encode()
        values = np.empty(len(stems.dictionary), object)
        values[:] = self.values(stems.dictionary.to_pylist())
        marks = np.zeros(len(words), object)
        for mark in (".", ","):
            at = pc.and_(plain, pc.ends_with(words, mark)).to_numpy(zero_copy_only=False)
            if at.any():
                marks[at] = self.values([mark])[0]
        return values[stems.indices.to_numpy()], marks


@lru_cache(maxsize=2)
def length_cache(path: str) -> WordCache:
    return WordCache(path, len)


@lru_cache(maxsize=2)
def bytes_cache(path: str) -> WordCache:
    """Words to their ids as little-endian unsigned 32-bit integers."""
    return WordCache(path, lambda ids: np.asarray(ids, "<u4").tobytes())


def token_lengths(texts: pa.Array, path: str, by_word: bool = True) -> np.ndarray:
    """The number of tokens of each text (null: empty)."""
    if not by_word:
        encode = load(path)
        return np.array([len(x) for x in encode(pc.fill_null(texts, "").to_pylist())], np.int64)
    words, starts = words_of(texts)
    if not len(words):
        return np.zeros(len(texts), np.int64)
    stems, marks = length_cache(path).parts(words.dictionary)
    lengths = stems.astype(np.int64) + marks.astype(np.int64)
    total = np.concatenate(([0], np.cumsum(lengths[words.indices.to_numpy()])))
    return total[starts[1:]] - total[starts[:-1]]


def token_bytes(texts: pa.Array, path: str, by_word: bool = True) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    if not by_word:
        encode = load(path)
        return [np.asarray(x, "<u4").tobytes() for x in encode(pc.fill_null(texts, "").to_pylist())]
    words, starts = words_of(texts)
    if not len(words):
        return [b""] * len(texts)
    stems, marks = bytes_cache(path).parts(words.dictionary)
    for i in np.flatnonzero(marks != 0):
        stems[i] += marks[i]
    each = stems[words.indices.to_numpy()].tolist()
    return [b"".join(each[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
