"""What each micro-batch took in and dropped, kept as a table.

Rows behind the watermark leave the stream without a trace in its output; the stateful operator
counts them. The driver reads these counts from the query's progress, a few numbers a batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

METRICS_DDL = "query_id STRING, batch_id BIGINT, input_rows BIGINT, dropped_rows BIGINT, state_rows BIGINT, watermark STRING"


def batch_metrics(query: StreamingQuery, after: int = -1) -> list[tuple]:
    """A row per micro-batch with input that the query still remembers, past the batch ``after``."""
    rows = {}
    for p in query.recentProgress:
        if p["batchId"] > after and p["numInputRows"]:
            state = p["stateOperators"]
            rows[p["batchId"]] = (
                str(p["id"]), p["batchId"], p["numInputRows"], sum(s["numRowsDroppedByWatermark"] for s in state),
                sum(s["numRowsTotal"] for s in state), (p["eventTime"] or {}).get("watermark"),
            )
    return [rows[b] for b in sorted(rows)]


def recorded(spark: SparkSession, query: StreamingQuery, path: str, poll_seconds: int = 30) -> None:
    """Wait for the query's end; every ``poll_seconds`` append the metrics of the batches that ended to ``path``.

    A query remembers its last 100 reports, so poll more often than that many batches take.
    The reports of the last batches are kept even if the query fails.
    """
    last, ended = -1, False
    try:
        while not ended:
            ended = bool(query.awaitTermination(poll_seconds))
            last = append(spark, query, path, last)
    finally:
        append(spark, query, path, last)


def append(spark: SparkSession, query: StreamingQuery, path: str, last: int) -> int:
    rows = batch_metrics(query, last)
    if rows:
        spark.createDataFrame(rows, METRICS_DDL).coalesce(1).write.mode("append").parquet(path)
        last = rows[-1][1]
    return last
