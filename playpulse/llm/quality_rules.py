"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

Every document gets counts over its whole text and, from them, a value in parts per thousand
for each rule. A rule rejects above a cutoff. Cutoffs come from labelled good documents that
pass the base rules: in a stratum with n of them, a cutoff that rejects k is valid if the
exact (Clopper-Pearson) upper bound of its false rejection rate is at most ``ALPHA`` / rules,
that is if the binomial probability of k or fewer among n at that rate is at most
``DELTA`` / (strata * rules * cutoffs) (Bonferroni over everything tried). Of the valid cutoffs
the one that rejects most labelled bad documents less the good ones is taken, the highest of
equals; without a valid one the rule is off. So, with probability 1 - ``DELTA``, no stratum
loses more than ``ALPHA`` of its good documents to the rules, whichever cutoffs are taken.

Null texts count as empty (and fail the base rules); a null stratum is the stratum ''; a null
or unlabelled id is judged like any other, but doesn't take part in the choice; a document
labelled both good and bad takes no part either; repeated ids and rows give a row each; without labels
all rules are off; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import free_name, staged, text_of

ALPHA = 0.05
DELTA = 0.05
CUTOFFS = [2, 5, 10, 20, 50, 100, 150, 200, 300, 400, 500, 700]
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPACE = r"[\x20\x09-\x0D]+"

#: Rule: parts per thousand of (count, of what).
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "shouts": ("n_shouts", "word_chars"),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` and a struct column ``name`` with the counts of each text.

    Each step is a column of its own, as Spark would evaluate a shared expression inside a
    lambda once an element.
    """
    step = {k: free_name(df, f"{name}_{k}") for k in ("text", "words", "hashes", "windows", "sorted", "found")}
    at = {k: F.col(v) for k, v in step.items()}
    lines = F.filter(F.split(at["text"], "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")
    twice = F.size(F.array_distinct(at["windows"])) < F.size(at["windows"])
    pairs = F.transform(at["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    equal = lambda x, j: (x["h"] == F.get(at["sorted"], j - 1)["h"]) | (x["h"] == F.get(at["sorted"], j + 1)["h"])
    places = F.sort_array(F.transform(F.filter(at["sorted"], lambda x, j: F.coalesce(equal(x, j), F.lit(False))), lambda x: x["i"]))
    gaps = F.transform(
        at["found"], lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at["found"], j + 1), p + WINDOW) - p)
    )
    covered = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    window = lambda h, i: F.xxhash64(h, *[F.get(at["hashes"], i + k) for k in range(1, WINDOW)])
    return (
        df.withColumn(step["text"], text)
        .withColumn(step["words"], F.filter(F.split(at["text"], SPACE, -1), lambda w: w != ""))
        .withColumn(step["hashes"], F.transform(at["words"], lambda w: F.xxhash64(w)))
        .withColumn(
            step["windows"],
            F.transform(F.slice(at["hashes"], F.lit(1), F.greatest(F.size(at["hashes"]) - (WINDOW - 1), F.lit(0))), window),
        )
        .withColumn(step["sorted"], F.when(twice, F.sort_array(pairs)).otherwise(F.slice(pairs, 1, 0)))
        .withColumn(step["found"], places)
        .withColumn(
            name,
            F.struct(
                F.size(at["words"]).cast("long").alias("n_words"),
                F.length(F.concat_ws("", at["words"])).cast("long").alias("word_chars"),
                F.regexp_count(at["text"], F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                covered.cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                F.regexp_count(at["text"], F.lit("[A-Z!]")).cast("long").alias("n_shouts"),
            ),
        )
        .drop(*step.values())
    )


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def per_thousand(c: Column, rule: str) -> Column:
    count, of = RULES[rule]
    return F.floor(1000 * c[count] / F.greatest(c[of], F.lit(1)))


def log_gamma(x: Column) -> Column:
    """Stirling's series eight places on, where it is exact to twelve digits."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for i in range(8):
        series = series - F.log(x + i)
    return series


def lower_tail(k: Column, n: Column, p: float) -> Column:
    """Binomial probability of k or fewer of n, for k < n p; 1 beyond, where no bound can hold.

    Summed from k downwards, as far as terms count.
    """
    k, n = k.cast("double"), n.cast("double")
    top = (
        log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    steps = F.least(k, 60 * F.sqrt(n * p) + 100).cast("int")
    down = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, j: F.struct((a["t"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"],
    )
    return F.when(k < n * p, F.exp(top) * down).otherwise(1.0)


def choose_cutoffs(labelled: DataFrame, alpha: float, delta: float, cutoffs: list[int]) -> DataFrame:
    """(stratum, one column per rule) from (stratum, label, one value per rule); at most one row a stratum."""
    rate = alpha / len(RULES)
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]))
    counted = labelled.select("stratum", "label", values.alias("x")).groupBy("stratum", "label", "x.rule", "x.value").agg(F.count("*").alias("m"))
    good, above = F.col("label") == 1, F.col("value") > F.col("cutoff")
    tried = (
        counted.withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs))))
        .groupBy("stratum", "rule", "cutoff")
        .agg(*[F.sum(F.when(w, F.col("m")).otherwise(0)).alias(n) for n, w in (("k", good & above), ("n", good), ("bad", ~good & above))])
    )
    strata = labelled.where(good).agg(F.count_distinct("stratum").alias("strata"))
    risk = F.lit(delta) / (F.greatest(F.col("strata"), F.lit(1)) * len(RULES) * len(cutoffs))
    valid = tried.join(F.broadcast(strata)).where(lower_tail(F.col("k"), F.col("n"), rate) <= risk)  # one row
    best = lambda r: F.max(F.when(F.col("rule") == r, F.struct((F.col("bad") - F.col("k")).alias("gain"), F.col("cutoff").alias("cutoff"))))
    return valid.groupBy("stratum").agg(*[best(r)["cutoff"].alias(f"max_{r}") for r in RULES])


def labels_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, label 0 or 1) of the documents with one label."""
    label = F.col(f"`{label_col}`")
    return (
        labels.where(F.col(f"`{id_col}`").isNotNull() & label.isin(0, 1))
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other")).where("label = other").drop("other")
    )


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    alpha: float = ALPHA,
    delta: float = DELTA,
    cutoffs: list[int] = CUTOFFS,
) -> tuple[DataFrame, DataFrame]:
    """The verdicts (doc_id, counts, base_failed, kept) and the cutoffs they rest on."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"),
        text_of(text_col).alias("text"),
    )
    counts = staged(with_counts(rows, F.col("text"), "c").select("doc_id", "stratum", "c"), "rule-counts")
    values = values_of(counts)
    chosen = staged(choose_cutoffs(labelled_values(values, labels, id_col, label_col), alpha, delta, cutoffs), "rule-cutoffs")
    passed = ~F.col("base_failed")
    for r in RULES:
        passed = passed & (F.col(r) <= F.coalesce(F.col(f"max_{r}"), F.lit(1000)))
    verdicts = values.join(chosen, "stratum", "left").select(
        "doc_id", *COUNTS, "base_failed", passed.alias("kept"), "n_lines", "n_shouts"
    )
    return verdicts, chosen


def values_of(counts: DataFrame) -> DataFrame:
    """Counts (doc_id, stratum, c) spread out, with what the rules make of them."""
    return counts.select(
        "doc_id", "stratum", "c.*", base_failed(F.col("c")).alias("base_failed"), *[per_thousand(F.col("c"), r).alias(r) for r in RULES]
    )


def labelled_values(values: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return values.where(~F.col("base_failed")).join(labels_of(labels, id_col, label_col), "doc_id")


def kept_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    alpha: float = ALPHA,
    delta: float = DELTA,
    cutoffs: list[int] = CUTOFFS,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The rows are written once with their counts; cutoffs are found on the counts alone, and
    the verdict is taken where the rows are read again. Texts are counted once, none is shuffled.
    """
    name, stratum = free_name(docs, "rule_counts"), free_name(docs, "rule_stratum")
    limits = {r: free_name(docs, f"rule_max_{r}") for r in RULES}
    rows = with_counts(docs, text_of(text_col), name).withColumn(
        stratum, F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit(""))
    )
    rows = staged(rows, "rule-documents")
    counts = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(stratum).alias("stratum"), F.col(name).alias("c"))
    chosen = staged(choose_cutoffs(labelled_values(values_of(counts), labels, id_col, label_col), alpha, delta, cutoffs), "rule-cutoffs")
    chosen = chosen.select(F.col("stratum").alias(stratum), *[F.col(f"max_{r}").alias(v) for r, v in limits.items()])
    passed = ~base_failed(F.col(name))
    for r, limit in limits.items():
        passed = passed & (F.coalesce(F.col(limit), F.lit(1000)) >= per_thousand(F.col(name), r))
    return rows.join(chosen, stratum, "left").where(passed).select(*[F.col(f"`{c}`") for c in docs.columns])


def sql(alpha: float = ALPHA, delta: float = DELTA, cutoffs: list[int] = CUTOFFS) -> str:
    """The same over ``documents`` and ``labels`` in DuckDB SQL."""
    rate = alpha / len(RULES)
    value = lambda c, of: f"1000 * {c} // greatest({of}, 1)"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM texts),
each AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM words),
windows AS (
  SELECT * FROM (
    SELECT rid, i, x || {" || ".join(f"' ' || lead(x, {k}) OVER here" for k in range(1, WINDOW))} AS g
    FROM each WINDOW here AS (PARTITION BY rid ORDER BY i))
  WHERE g IS NOT NULL),
repeats AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + {WINDOW})) AS p
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS m FROM windows) WHERE m > 1)
  GROUP BY rid),
counts AS (
  SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
         length(regexp_replace(text, '[^A-Z!]', '', 'g')) AS n_shouts
  FROM texts JOIN words USING (rid) LEFT JOIN repeats USING (rid)),
vals AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {", ".join(f"{value(*RULES[r])} AS {r}" for r in RULES)}
  FROM counts),
labelled AS (
  SELECT stratum, label, {", ".join(RULES)} FROM vals JOIN (
    SELECT doc_id, min(quality) AS label FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1)
    GROUP BY doc_id HAVING min(quality) = max(quality)) USING (doc_id)
  WHERE NOT base_failed),
tried AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (value > cutoff AND label = 1) AS k, count(*) FILTER (label = 1) AS n,
         count(*) FILTER (value > cutoff AND label = 0) AS bad
  FROM ({" UNION ALL ".join(f"SELECT stratum, label, '{r}' AS rule, {r} AS value FROM labelled" for r in RULES)})
  CROSS JOIN (SELECT unnest({cutoffs}) AS cutoff) GROUP BY ALL),
valid AS (
  SELECT stratum, rule, arg_max(cutoff, (bad - k) * 10000 + cutoff) AS cutoff FROM tried
  WHERE k < n * {rate} AND list_sum(list_transform(range(0, k + 1), lambda j: exp(
          lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({rate}) + (n - j) * ln(1 - {rate}))))
        <= {delta} / ((SELECT count(DISTINCT stratum) FROM labelled WHERE label = 1) * {len(RULES) * len(cutoffs)})
  GROUP BY ALL),
chosen AS (
  SELECT stratum, {", ".join(f"min(cutoff) FILTER (rule = '{r}') AS max_{r}" for r in RULES)} FROM valid GROUP BY stratum)
SELECT doc_id, {", ".join(f"{c}::BIGINT AS {c}" for c in COUNTS)}, base_failed,
       NOT base_failed AND {" AND ".join(f"{r} <= coalesce(max_{r}, 1000)" for r in RULES)} AS kept,
       n_lines::BIGINT AS n_lines, n_shouts::BIGINT AS n_shouts
FROM vals LEFT JOIN chosen USING (stratum)"""
