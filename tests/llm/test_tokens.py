import public_tokenizers
import pyarrow as pa
import zlib
from collections import defaultdict

import numpy as np

from playpulse.llm.packing import CAPACITY, cut_lengths, pack_documents
from playpulse.llm.token_counts import count_tokens
from playpulse.llm.tokens import REMEMBERED, WordCache, load, token_bytes, token_lengths

from . import odd

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "a<|endoftext|>b c", "it's don't x'll y\u0085z", "́ á e ́", "日本語 テスト 123", "<|startoftext|><|endoftext|> x<|end oftext|>",
    "", "  ", "I'm\x1cwe're İ ΑΣ ΑΣΑ", "x y ﬁ", "Ende. ENDE, end., end.. .", None, "<|ENDOFTEXT|>.",
]


def whole(text):
    return load(PATH)([text or ""])[0]


def test_words_give_the_ids_of_whole_texts():
    texts = [*TRICKY, *[t for _, t in odd.texts()]]
    array = pa.array(texts, pa.string())
    assert token_lengths(array, PATH).tolist() == [len(whole(t)) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in token_bytes(array, PATH)] == [whole(t) for t in texts]
    assert token_lengths(array, PATH, by_word=False).tolist() == [len(whole(t)) for t in texts]


def test_plain_letters_with_a_mark_are_split_safely():
    import re

    letters = [c for c in map(chr, range(0x41, 0x180)) if re.match("[A-Za-zÀ-ÖØ-öø-įı-ſ]", c)]
    words = ["xa" + c + "b" + end for c in letters for end in ("", ".", ",")] + letters
    assert token_lengths(pa.array(words), PATH).tolist() == [len(x) for x in load(PATH)(words)]


def test_a_full_cache_starts_again():
    cache = WordCache(PATH, len)
    cache.known = dict.fromkeys(map(str, range(REMEMBERED)), 1)
    assert cache.values(["hello", "world"]) == [1, 1] and len(cache.known) == 2


def test_counts(spark):
    got = count_tokens(odd.documents(spark), PATH).collect()
    want = sorted(((i or 0), len((t or "").encode()), len(whole(t))) for i, t in odd.texts())
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert count_tokens(odd.empty(spark), PATH).count() == 0


def test_other_tokenizers_take_whole_texts(spark):
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        got = count_tokens(odd.documents(spark).where("doc_id = 7"), path, by_word=False).first()
        assert got.n_tokens == len(load(path)(["two words"])[0])


def test_cuts():
    for n in range(1, 5000):
        cut = cut_lengths(n, 2048, 128)
        assert sum(cut) == n and max(cut) <= 2048 and all(x in (2048, 1024, 512, 256, 128) for x in cut[:-1])


def test_packing_round_trip(spark):
    docs = odd.documents(spark)
    rows = pack_documents(docs, PATH).collect()
    ids = defaultdict(list)
    for i, t in odd.texts():
        ids[i].append([*whole(t), 1])
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= CAPACITY
    for (doc, n), rs in pieces.items():
        wanted = [x for x in ids[doc] if len(x) == n]
        found = []
        for x in wanted:
            found += [(a, r.length) for r in rs for a in [r.start] if zlib.crc32(np.asarray(x[a : a + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert sum(r.length for r in rs) == n * len(wanted) and len(found) >= len(rs)
    assert {k for k in ids} == {d for d, _ in pieces}
    assert pack_documents(odd.empty(spark), PATH).count() == 0


def test_packing_leaves_little_padding(spark):
    docs = spark.createDataFrame([(i, odd.prose(i, 20 + i * 7 % 900)) for i in range(600)], "doc_id long, text string")
    rows = pack_documents(docs, PATH).groupBy("sequence_id").sum("length").collect()
    lengths = [r[1] for r in rows]
    padding = sum(0 if n & (n - 1) == 0 else CAPACITY - n for n in lengths)
    assert padding < 0.03 * sum(lengths)


def test_tiny_documents_fill_their_sequences(spark):
    docs = spark.createDataFrame([(i, f"{'ab' if i % 2 else 'cd'} ef") for i in range(6400)], "doc_id long, text string")
    lengths = [r[1] for r in pack_documents(docs, PATH).groupBy("sequence_id").sum("length").collect()]
    assert sum(lengths) > 0.9 * CAPACITY * len(lengths)


def test_whether_words_may_be_used_is_found_out(spark):
    from playpulse.llm.tokens import splits_safely

    names = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
    assert [splits_safely(public_tokenizers.path(n)) for n in names] == [True, False, False]
    for name in names[1:]:
        path = public_tokenizers.path(name)
        got = count_tokens(odd.documents(spark).where("doc_id in (7, 12, 15, 16)"), path).collect()
        want = sorted((i, len(load(path)([t])[0])) for i, t in odd.texts() if i in (7, 12, 15, 16))
        assert sorted((r.doc_id, r.n_tokens) for r in got) == want
