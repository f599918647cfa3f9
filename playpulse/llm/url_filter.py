"""URL filters: rules by longest match, and gradient-boosted trees on lexical features for the rest.

A rule is a host and a path: it fits the host and its subdomains if the path starts with the
rule's. The rule whose text is longest decides. URLs that no rule fits are judged by
gradient-boosted trees (Spark ML, on the JVM) trained on labelled URLs: a table of them, or
without one the distinct URLs that the rules decide. About ``TRAIN_ROWS`` of them at most are
learned from, half of them of each verdict as far as there are so many, chosen by a hash.
Features: length, depth, digit ratio, entropy, parameter count, the host's labels and hyphens,
and for the host's suffix and the path's first part the share of blocked ones among the
labelled URLs that have it, smoothed towards one half; for a URL that is learned from, its own
label is left out of these shares. Both verdicts weigh the same in training,
so a URL that resembles neither is not judged by which verdict has more labels.

Null URLs and URLs without ``://`` have an empty host and path and are judged by the trees on
these empty values. Without labelled URLs of both verdicts there is nothing to learn: then the
one verdict seen, or else allow, holds. Null and repeated ids and rows give a row each; an
empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import staged

#: (verdict, host, path), fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 10, 3, 17
SMOOTHING = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GROUPS = ["suffix", "head"]
FEATURES = [
    "url_length", "host_length", "depth", "digit_ratio", "entropy", "params", "labels", "hyphens",
    *[f"{g}_rate" for g in GROUPS],
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def with_features(df: DataFrame) -> DataFrame:
    """``df`` (url, host, path, ...) with its lexical features and the groups whose statistics count."""
    u, host, path = F.col("url"), F.col("host"), F.col("path")
    n = F.greatest(F.length(u), F.lit(1))
    of_char = F.transform(F.array_distinct(F.split(u, "")), lambda c: F.length(u) - F.length(F.replace(u, c, F.lit(""))))
    bits = F.aggregate(F.filter(of_char, lambda c: c > 0), F.lit(0.0), lambda a, c: a + c * F.log2(c))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    return df.select(
        "*",
        F.length(u).alias("url_length"),
        F.length(host).alias("host_length"),
        F.regexp_count(path, F.lit("/[^/]")).alias("depth"),
        (F.regexp_count(u, F.lit("[0-9]")) / n).alias("digit_ratio"),
        (F.log2(n) - bits / n).alias("entropy"),
        F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1).alias("params"),
        F.regexp_count(host, F.lit("[^.]+")).alias("labels"),
        F.regexp_count(host, F.lit("-")).alias("hyphens"),
        F.regexp_extract(host, r"[^.]*$", 0).alias("suffix"),
        F.regexp_extract(path, r"^/([^/]*)", 1).alias("head"),
    )


def with_statistics(df: DataFrame, statistics: dict[str, DataFrame], own_label: bool = False) -> DataFrame:
    """``df`` with the smoothed share of blocked URLs of each group, of rows with a label without their own."""
    bad, one = (F.col("label"), F.lit(1)) if own_label else (F.lit(0), F.lit(0))
    for g in GROUPS:
        df = df.join(statistics[g], g, "left").withColumns({
            f"{g}_rate": (F.coalesce(F.col(f"{g}_bad"), F.lit(0)) - bad + SMOOTHING / 2) / (F.coalesce(F.col(f"{g}_n"), F.lit(0)) - one + SMOOTHING),
        })
    return df


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every row.

    ``labelled``: (url, verdict); None takes the URLs that the rules decide. ``block_score`` is
    the trees' probability of a block, null where there was nothing to learn.
    """
    host, path = parts(F.col("url"))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = staged(with_features(rows.withColumns({"rule": rule, "ruled": verdict})), "urls")
    if labelled is None:
        known = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    else:
        known = labelled.select(F.coalesce("url", F.lit("")).alias("url"), (F.col("verdict") == "block").cast("double").alias("label"))
        known = with_features(known.where("label is not null").withColumns({"host": host, "path": path}))
    columns = ["host", "path", *FEATURES[: -len(GROUPS)], *GROUPS]
    known = staged(known.groupBy("url").agg(F.max("label").alias("label"), *[F.first(c).alias(c) for c in columns]), "labelled-urls")
    total, bad = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < bad < total:
        default = "block" if total and bad == total else "allow"
        return rows.select(
            "page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(default)).alias("verdict"), F.lit(None).cast("double").alias("block_score")
        )
    statistics = {
        g: staged(known.groupBy(g).agg(F.count("*").alias(f"{g}_n"), F.sum("label").alias(f"{g}_bad")), f"{g}-statistics") for g in GROUPS
    }
    wide = 1 << 20
    of_verdict = F.when(F.col("label") == 1, F.lit(bad)).otherwise(F.lit(total - bad))
    share = F.least(F.lit(wide), F.ceil(wide * train_rows / 2 / of_verdict))
    weight = F.when(F.col("label") == 1, 0.5 / bad).otherwise(0.5 / (total - bad)) * F.lit(float(total)) * wide / share
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = with_statistics(known.where(F.pmod(F.xxhash64("url"), F.lit(wide)) < share), statistics, own_label=True)
    train = assemble.transform(train).select("features", "label", weight.alias("weight"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32, weightCol="weight").fit(train)
    scored = trees.transform(assemble.transform(with_statistics(rows, statistics)))
    score = vector_to_array(F.col("probability"))[1]
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("block_score"),
    )
