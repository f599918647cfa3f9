"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(key, comp) of every key in ``links`` (a, b); ``comp`` is the smallest key that it reaches.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so paths shorten as powers of two. Rounds are written tables; only the number of
    changed labels comes to the driver.
    """
    edges = staged(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "edges"
    )
    labels = edges.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("comp"))
    labels = staged(labels, "labels")
    while True:
        near = (
            edges.join(labels, edges["b"] == labels["key"]).groupBy(F.col("a").alias("near_key")).agg(F.min("comp").alias("near"))
        )
        step = staged(
            labels.join(near, labels["key"] == near["near_key"])
            .select("key", "comp", F.least("comp", "near").alias("next")),
            "labels",
        )
        of_label = step.select(F.col("key").alias("label"), F.col("next").alias("jump"))
        jumped = staged(
            step.join(of_label, step["next"] == of_label["label"], "left")
            .select("key", F.least("next", F.coalesce("jump", "next")).alias("comp"), (F.col("comp") != F.least("next", F.coalesce("jump", "next"))).alias("moved")),
            "labels",
        )
        labels = jumped.select("key", "comp")
        if jumped.where("moved").limit(1).count() == 0:
            return labels
