import hashlib
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from playpulse.llm import secret_scan
from playpulse.llm.randomness import chi2_tail, encoding_of, randomness
from playpulse.llm.topk_search import Tree, search, top_k

from . import odd


def brute_top(rows, k):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in sorted(ok, reverse=True)}.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in r.normal(size=12).astype(np.float32)]) for i in range(700)]
    rows += [(700 + i, rows[0][1]) for i in range(60)]  # one vector again and again
    rows += [(1000, None), (1001, []), (1002, [1.0, None]), (1003, [float("nan")] * 12), (None, rows[1][1]), (1050, [0.5] * 3), (1051, [0.25] * 3), (50, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    rows = [(i, v and [np.float32(x) if x is not None else None for x in v]) for i, v in rows]
    got = top_k(df, F.col("vec_id") % 50 == 0, shard_rows=100, query_block=4, leaf=8)
    ids = [q for q in {r.query_id for r in got.collect()}]
    want = [x for x in brute_top(rows, 5)]
    mine = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())
    assert mine == want
    assert 50 in ids and 1050 in ids  # 50 is there twice: its smaller vector asks
    assert top_k(df.where("vec_id is null"), F.col("vec_id") % 50 == 0).count() == 0
    assert top_k(df, F.lit(False)).count() == 0


def test_large_components_stay_exact():
    points = np.floor(np.array([[2.0**40, 1], [2.0**40, 2], [-3, 5]]))
    got = search(Tree(points, np.array([1, 2, 3]), 1), np.array([9]), np.array([[2.0**20, 3.0]]), [None], 2)
    assert sorted(got) == [(9, 1, 2**60 + 3), (9, 2, 2**60 + 6)]


def test_a_tree_opens_few_boxes():
    r = np.random.default_rng(2)
    points = np.floor(256 * r.normal(size=(4096, 2)))
    tree = Tree(points, np.arange(4096), 16)
    assert len(tree.span) > 256
    got = search(tree, np.array([-1]), np.array([[100.0, 30.0]]), [None], 5)
    want = sorted((points @ [100.0, 30.0]).astype(int))[-5:]
    assert sorted(s for _, _, s in got) == want


def base_of(text):
    text, out = text or "", []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def secrets():
    r = random.Random(8)
    rand = lambda n, s: "".join(r.choices(s, k=n))
    hexa, b62 = "0123456789abcdef", string.ascii_letters + string.digits
    rows = [
        'token = "' + rand(40, hexa) + '" é', "PassWord:abc", "secret=token =abcdefg", "api_key: abcdef", "ſecret=abcdefgh", "AKIA" + rand(16, "ABCDEF234"),
        "AKIA" + "X" * 15, "x" + rand(24, hexa) + "g", rand(23, hexa), "APIKEY='" + rand(9, b62) + "'", None, "", odd.LONG,
        "Donaudampfschifffahrtsgesellschaft2024 und averyveryveryverylongname_with_parts_2", "4041894974608795404189497",
    ]
    return rows + [f"wort {rand(40, b62)} wort" for _ in range(60)]


def test_patterns_and_randomness(spark):
    rows = list(enumerate(secrets()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(None, "password=abcdefgh", "x")], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in secret_scan.scan_secrets(df).collect()}
    for i, t in rows:
        assert got[i].base_sha256 == hashlib.sha256(base_of(t).encode()).hexdigest(), t
        base = [s for s in got[i].spans.split(",") if s and not s.startswith("random")]
        assert ",".join(base) == base_of(t)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(base_of(t).count(k) for k in ("assign", "access", "hex"))
    assert sum(got[i].n_random for i in range(len(rows) - 60, len(rows))) >= 57
    assert not any(got[i].n_random for i, t in rows if t and ("Donau" in t or t[0] == "4" or t == odd.LONG))
    assert got[None].n_assign == 1
    assert secret_scan.scan_secrets(odd.empty(spark)).count() == 0


def test_redaction_keeps_rows_and_columns(spark):
    docs = odd.documents(spark).unionByName(
        odd.documents(spark).limit(1).withColumns({"doc_id": F.lit(77).cast("long"), "text": F.lit('é token = "0123456789abcdef0123456789" und')})
    )
    out = secret_scan.redacted(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()
    row = out.where("doc_id = 77").first()
    assert row.text == 'é [SECRET]" und' and row.n_chars == len(row.text)
    assert out.where("doc_id != 77 or doc_id is null").exceptAll(docs).count() == 0
    assert secret_scan.masked("abcdefgh", [(1, 4), (2, 6), (1, 3)]) == "a[SECRET]gh"


def test_battery():
    assert abs(chi2_tail(3.841458820694124, 1) - 0.05) < 1e-9 and abs(chi2_tail(18.307038053275146, 10) - 0.05) < 1e-9
    assert chi2_tail(0, 5) == 1 and chi2_tail(1000, 2) < 1e-200
    assert encoding_of("0123456789abcdef0123") == "hex" and encoding_of("12345678901234567890") is None
    assert encoding_of("averylongwordwithoutdigits") is None and encoding_of("aB3" * 8) == "base62"
    r = random.Random(4)
    b62 = string.digits + string.ascii_letters
    ts = [randomness("".join(r.choices(b62, k=r.randint(20, 80))), "base62") for _ in range(2000)]
    assert 0.03 < np.mean(np.array(ts) < 0.05) < 0.09 and 0.42 < np.mean(ts) < 0.56
    assert randomness("averyveryveryverylongname2", "base62") < 0.001


def naive_tests(values, size):
    """The three p-values from their definitions, with tails by numerical integration."""
    from statistics import NormalDist

    n = len(values)
    bins = max(2, min(size, n // 5))
    cell = [v * bins // size for v in range(size)]
    expected = [n * cell.count(b) / size for b in range(bins)]
    stat = sum((sum(cell[v] == b for v in values) - e) ** 2 / e for b, e in enumerate(expected))
    df = bins - 1
    grid = np.linspace(0, 1, 200_001)[1:-1]
    tail = lambda x, k: 1.0 if x <= 0 else _chi_tail(x, k, grid)
    high = [2 * v >= size for v in values]
    a, b = high.count(True), high.count(False)
    if a and b and a + b >= 3:
        runs = len([1 for i in range(n) if i == 0 or high[i] != high[i - 1]])
        mean, var = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        p_runs = 2 * NormalDist().cdf(-abs(runs - mean) / var**0.5)
    else:
        p_runs = 2.0 ** (1 - n)
    mid = (size - 1) / 2
    z = sum((x - mid) * (y - mid) for x, y in zip(values, values[1:])) / ((size**2 - 1) / 12 * (n - 1) ** 0.5)
    return [tail(stat, df), p_runs, 2 * NormalDist().cdf(-abs(z))], tail


def _chi_tail(x, k, grid):
    """Upper tail of chi-squared by integrating its density from x on, t = x / u."""
    import math

    t = x / grid
    log = (k / 2 - 1) * np.log(t) - t / 2 - (k / 2) * math.log(2) - math.lgamma(k / 2)
    return float(np.trapezoid(np.exp(log) * x / grid**2, grid))


def test_the_battery_against_its_definitions():
    from playpulse.llm.randomness import ENCODINGS

    r = random.Random(21)
    for name, symbols in ENCODINGS.items():
        for n in (20, 33, 64, 130):
            for token in ("".join(r.choices(symbols, k=n)), "".join(r.choices(symbols[: len(symbols) // 3], k=n))):
                ps, tail = naive_tests([symbols.index(c) for c in token], len(symbols))
                want = tail(-2 * sum(np.log(max(p, 1e-300)) for p in ps), 6)
                assert abs(randomness(token, name) - want) < 1e-4, (name, token)


def test_uncovered_parts_of_a_token_are_tested():
    r = random.Random(5)
    b64 = string.ascii_letters + string.digits
    token = f"v1_{''.join(r.choices('0123456789abcdef', k=32))}_{''.join(r.choices(b64, k=30))}"
    text = f"x {token} y"
    spans = secret_scan.base_spans(text)
    assert [(a, b) for a, _, b in spans] == [(5, 37)]
    assert [(a, b) for a, b, *_ in secret_scan.candidates(text, spans)] == [(37, 68)]
    for trial in range(300):  # random spans: what they leave, by marking single characters
        size = r.randint(20, 120)
        text = "".join(r.choices(b64, k=size))
        spans = sorted((a, r.randint(0, 2), min(size, a + r.randint(1, 30))) for a in (r.randrange(size) for _ in range(r.randint(0, 5))))
        free = "".join("x" if not any(a <= i < b for a, _, b in spans) else " " for i in range(size))
        want = [(m.start(), m.end()) for m in re.finditer("x{20,}", free) if encoding_of(text[m.start() : m.end()])]
        assert [(a, b) for a, b, *_ in secret_scan.candidates(text, spans)] == want


def test_masking_leaves_nothing_of_a_mixed_token(spark):
    r = random.Random(9)
    b64 = string.ascii_letters + string.digits
    rows = [(i, f"wort v1_{''.join(r.choices('0123456789abcdef', k=32))}_{''.join(r.choices(b64, k=30))} wort") for i in range(80)]
    out = secret_scan.redacted(spark.createDataFrame(rows, "doc_id long, text string"), length_col=None).collect()
    assert sum(row.text == "wort v1_[SECRET][SECRET] wort" for row in out) >= 76


def test_a_text_of_many_tokens_and_spans_takes_linear_time(spark):
    import time

    r = random.Random(3)
    b64 = string.ascii_letters + string.digits
    text = " ".join(f"{''.join(r.choices(b64, k=40))} {''.join(r.choices('0123456789abcdef', k=40))} wort" for _ in range(100_000))
    assert len(text) > 8_000_000
    began = time.time()
    spans = secret_scan.base_spans(text)
    tokens = secret_scan.candidates(text, spans)
    assert len(spans) >= 100_000 and len(tokens) >= 99_000
    assert len(secret_scan.masked(text, [(a, b) for a, _, b in spans])) < len(text)
    assert time.time() - began < 60
