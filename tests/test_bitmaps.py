"""Dense ids and bitmaps: exact, mergeable, and extended without renumbering."""

import random

from helpers import curated

from playpulse.operators.bitmaps import dense_ids, distinct_bitmaps, distinct_counts, release_view, session_sums
from playpulse.operators.extras import build_release_view
from playpulse.operators.sessions import build_sessions


def test_ids_are_dense_and_stay(spark):
    first = spark.createDataFrame([(f"v{i % 700}",) for i in range(2000)] + [(None,)], "v string")
    known = dense_ids(first, "v")
    ids = {r.v: r.id for r in known.collect()}
    assert sorted(ids.values()) == list(range(1, 701))
    more = dense_ids(spark.createDataFrame([(f"v{i}",) for i in range(650, 1000)], "v string"), "v", known.cache())
    got = {r.v: r.id for r in more.collect()}
    assert {v: i for v, i in got.items() if v in ids} == ids and sorted(got.values()) == list(range(1, 1001))
    assert dense_ids(first.where("false"), "v").count() == 0


def test_counts_of_any_grain_equal_recounts(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice(["x", "y"]), f"p{r.randrange(70_000)}") for _ in range(90_000)]
    df = spark.createDataFrame(rows, "g string, h string, p string").cache()
    bits = distinct_bitmaps(df, ["g", "h"], {"p": dense_ids(df, "p")}).cache()
    assert bits.agg({"block": "max"}).first()[0] >= 2  # ids over several blocks
    for by in (["g", "h"], ["g"], []):
        want = {}
        for row in rows:
            want.setdefault(tuple(row["gh".index(c)] for c in by), set()).add(row[2])
        got = {tuple(x[c] for c in by): x["p"] for x in distinct_counts(bits, by, ["p"]).collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_release_view_without_reading_sessions_again(spark, tmp_dir):
    r = random.Random(5)
    sessions = build_sessions(curated(spark, [
        dict(event_time=f"2024-01-0{r.randint(1, 3)} 10:{r.randrange(60):02}:00", player_key=f"p{r.randrange(30)}", session_id=f"s{r.randrange(60)}",
             platform=r.choice(["ios", "android", None]), build=r.choice(["1", "2", None]), category=r.choice(["user", "error"])) for _ in range(500)
    ]))
    by = ["game_id", "event_date", "platform", "build", "country_code"]
    distinct_bitmaps(sessions, by, {c: dense_ids(sessions, c) for c in ("player_key", "session_id")}).write.parquet(tmp_dir + "/bits")
    session_sums(sessions, by).write.parquet(tmp_dir + "/sums")
    got = release_view(spark.read.parquet(tmp_dir + "/bits"), spark.read.parquet(tmp_dir + "/sums"), 2)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, build_release_view(sessions, 2).select(got.columns).collect())) != []
    assert "session_id" not in got._jdf.queryExecution().executedPlan().toString().replace("session_id AS kind", "").split("FileScan")[1]
