import hashlib

import pytest
from pyspark.sql import functions as F

from playpulse.functions.privacy import player_key, pseudonymize_player_id, suppress_small_groups
from playpulse.functions.rules import (
    is_supported_category,
    is_valid_progression_status,
    normalize_category,
    percent,
    safe_rate,
)


def test_category_rule(spark):
    df = spark.createDataFrame([("Progression",), ("business",), (" Error ",), ("unknown",), (None,)], "c string")
    got = [r[0] for r in df.select(is_supported_category(normalize_category("c"))).collect()]
    assert got == [True, True, True, False, False]
    # the scalar rule lower-cases but does not trim
    got = [r[0] for r in df.select(is_supported_category("c")).collect()]
    assert got == [True, True, False, False, False]


def test_status_rule(spark):
    df = spark.createDataFrame([("start",), ("Complete",), ("pause",), (None,)], "s string")
    assert [r[0] for r in df.select(is_valid_progression_status("s")).collect()] == [True, True, False, False]


def test_safe_rate(spark):
    df = spark.createDataFrame([(1, 4), (3, 0), (2, None), (5, 2)], "n long, d long")
    assert [r[0] for r in df.select(safe_rate("n", "d")).collect()] == [0.25, 0.0, 0.0, 2.5]


@pytest.mark.parametrize(
    "n,d,expected",
    [(1, 3, 33.33), (2, 3, 66.67), (0, 0, 0.0), (1, 32, 3.13), (3, 32, 9.38), (7, 7, 100.0), (107, 4000, 2.68), (1, 4000, 0.03)],
)
def test_percent_takes_ties_away_from_zero(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n long, d long")
    assert df.select(percent("n", "d")).first()[0] == expected


def test_percent_column_inputs_match_name_inputs(spark):
    rows = [(n, d) for d in (0, 1, 3, 7, 32, 4000) for n in (0, 1, 2, 3, 107, 999)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select(percent("n", "d").alias("a"), percent(F.col("n"), F.col("d") + 0).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_player_key_known_digest(spark):
    df = spark.createDataFrame([("player-42",), (None,)], "user_id string")
    got = [r[0] for r in df.select(player_key("user_id", "salt")).collect()]
    assert got[0] == hashlib.sha256(b"saltplayer-42").hexdigest()
    assert got[1] == hashlib.sha256(b"saltmissing").hexdigest()


@pytest.mark.parametrize("salt", [None, ""])
def test_player_key_needs_salt(spark, salt):
    with pytest.raises(ValueError):
        player_key("user_id", salt)


def test_pseudonymize_drops_raw_id(spark):
    df = spark.createDataFrame([("e1", "u1")], "event_uuid string, user_id string")
    out = pseudonymize_player_id(df, "s")
    assert out.columns == ["event_uuid", "player_key"]


def test_suppression_threshold(spark):
    df = spark.createDataFrame([("a", 19), ("b", 20), ("c", 21)], "g string, n long")
    kept = sorted(r.g for r in suppress_small_groups(df, "n", 20).collect())
    assert kept == ["b", "c"]
    assert suppress_small_groups(df, F.col("n"), 20).count() == 2
