import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from playpulse.llm import mixing, quality_rules, secret_scan
from playpulse.llm.packing import CLASS_IDS, pack_documents
from playpulse.llm.tokens import load

from . import odd
from .test_ngram_join import brute


def test_stages_against_brute_force(spark, tmp_path):
    docs = odd.documents(spark).unionByName(
        spark.createDataFrame(
            [(100 + i, odd.prose(i % 50, 60) + (' token = "0123456789abcdef0123456789"' if i % 7 == 0 else ""), "en", f"src{i % 5}", 1, *["x"] * len(odd.CLASHES)) for i in range(150)],
            odd.SCHEMA,
        )
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = odd.labels(spark, [(i, 1, 0) for i in range(100, 250)])
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.schema(out.schema).parquet(f"{tmp_path}/{k}"))
        if k < 4:
            assert out.schema.names == docs.schema.names
    rows = [sorted(((r.doc_id or -1, r.text, r.n_chars) for r in f.collect()), key=repr) for f in frames[:-1]]

    verdicts = quality_rules.judged(docs, labels)[0].where("kept").collect()
    assert sorted(r[0] for r in rows[1]) == sorted(r.doc_id or -1 for r in verdicts)
    assert not any(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) < 10 for r in rows[1])

    groups = brute([(d if d >= 0 else None, t) for d, t, _ in rows[1]])
    want = {c if c is not None else -1 for _, _, c in groups}
    assert sorted(r[0] for r in rows[2]) == sorted(want)

    texts = {d: t for d, t, _ in rows[2]}
    assert {d: t for d, t, _ in rows[3]} == {
        d: secret_scan.masked(t, [(a, b) for a, _, b in secret_scan.base_spans(t)]) for d, t in texts.items()
    }
    assert any("[SECRET]" in t for _, t, _ in rows[3]) and not any("0123456789abcdef" in t for _, t, _ in rows[3])
    assert rows[4] == rows[3]

    order = [r.doc_id for r in sorted(mixing.mix_sources(frames[3]).collect(), key=lambda r: r.position)]
    assert [r.doc_id for r in mixing.in_mix_order(frames[3]).collect()] == order

    encode = load(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*encode([t])[0], 1] for d, t, _ in rows[4]}
    pieces = frames[5].collect()
    assert {r.doc_id if r.doc_id is not None else -1 for r in pieces} == set(ids)
    for r in pieces:
        x = ids[r.doc_id if r.doc_id is not None else -1]
        assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(np.asarray(x[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in pieces) == sum(map(len, ids.values()))


def test_empty_tables(spark, tmp_path):
    odd.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    odd.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def sequences(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        out.setdefault(r.sequence_id, []).append(r)
    return out


def test_packing_follows_the_mix(spark):
    rows = [(i, odd.prose(i, 20 + i * 7 % 900), None, "hot" if i % 10 else f"src{i % 3}", 1, *["x"] * len(odd.CLASHES)) for i in range(400)]
    docs = spark.createDataFrame(rows, odd.SCHEMA)
    orders = {}
    for name, weights in (("recipe", mixing.RECIPE), ("flat", {"hot": 9, "*": 1})):
        position = {r.doc_id: r.position for r in mixing.mix_sources(docs, weights).collect()}
        out = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), weights=weights).collect()
        assert {r.doc_id for r in out} == set(position)
        found = sequences(out)
        last = {}
        for s, pieces in found.items():
            first = min(position[r.doc_id] for r in pieces)
            assert {r.sequence_position for r in pieces} == {first}
            k = s // CLASS_IDS
            if k:  # filled by one class: in the order of the mix within and between sequences
                at = [(position[r.doc_id], r.start) for r in pieces]
                assert at == sorted(at) and at[0] > last.get(k, (-1, 0))
                last[k] = at[-1]
        assert len(last) > 5
        orders[name] = {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in out}
    assert orders["recipe"].keys() == orders["flat"].keys() and orders["recipe"] != orders["flat"]


def test_stages_pack_by_the_recipe(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame(
        [(i, odd.prose(i, 20 + i % 90), "en", f"src{i % 2}", 1, *["x"] * len(odd.CLASHES)) for i in range(200)], odd.SCHEMA
    )
    got = []
    for weights in (corpus_pipeline.RECIPE, {"src1": 9, "*": 1}):
        monkeypatch.setattr(corpus_pipeline, "RECIPE", weights)
        got.append({(r.doc_id, r.start): (r.sequence_id, r.offset) for r in corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()})
    assert got[0].keys() == got[1].keys() and got[0] != got[1]


def test_a_run_leaves_no_text(spark, tmp_path):
    """Every file left in the shared folder after the result is written, looked through for words of the texts."""
    import glob
    import os

    import corpus_pipeline
    import pyarrow.parquet as pq

    from playpulse.config import shared_dir

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("driver tables not present")
    before = set(os.listdir(shared_dir(spark)))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    out.write.parquet(str(tmp_path / "out"))
    left = sorted(set(os.listdir(shared_dir(spark))) - before)
    for name in left:
        for f in glob.glob(f"{shared_dir(spark)}/{name}/**/*.parquet", recursive=True):
            columns = pq.read_schema(f).names
            assert "text" not in columns and "hashes" not in columns, (name, columns)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_temporary_tables_go_and_kept_ones_stay(spark):
    import os

    from playpulse.llm.common import staged, temporary

    with pytest.raises(RuntimeError):
        with temporary(spark):
            with temporary(spark):
                inner, kept = staged(spark.range(3), "inner"), staged(spark.range(4), "kept", keep=True)
                paths = [os.path.dirname(df.inputFiles()[0].removeprefix("file://")) for df in (inner, kept)]
            assert [os.path.exists(p) for p in paths] == [False, True] and kept.count() == 4
            raise RuntimeError
    assert not os.path.exists(paths[1])
    last = staged(spark.range(2), "last")
    assert last.count() == 2
