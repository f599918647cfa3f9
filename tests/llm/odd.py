"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"wort{i % 977} und{i % 13}" for i in range(30_000))
CLASHES = ["words", "n", "key", "c", "kind", "gram", "hashes", "slot", "position", "rule_counts", "mix_s", "stratum", "part", "block", "spans", "label", "score"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abdeghiklmnorstu", k=r.randint(1, 9))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 200)
    words = base.split()
    near = " ".join([*words[:100], "changed", *words[101:]])
    return [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "two words"), (8, "Two WORDS"), (9, "one"),
        (10, LONG), (11, LONG + " end"), (12, prose(2, 50)), (12, prose(2, 50)), (None, prose(3, 30)), (None, base), (13, "x" * 5000),
        (14, "tok" + "".join("éß中"[i % 3] for i in range(300))), (15, "a b c d e f g " * 40), (16, prose(4, 40) + "\n" + prose(5, 40)),
    ]


def documents(spark: SparkSession) -> DataFrame:
    rows = [
        (i, t, ["en", "de", None][k % 3], ["src0", None, "src1", "unknown"][k % 4], len(t) if t is not None else None, *["x"] * len(CLASHES))
        for k, (i, t) in enumerate(texts())
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
