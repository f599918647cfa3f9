"""Data-quality gate over the curated event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.functions.rules import SUPPORTED_CATEGORIES

# Columns whose absence makes a curated row unusable (player_key stands in for user_id).
GATE_REQUIRED = ["event_uuid", "game_id", "player_key", "session_id", "event_time", "category"]

# Fixed order of the checks and their failure messages.
CHECKS = [
    ("row_count", "No events found for {day}"),
    ("missing_required", "{n} rows have missing required fields"),
    ("duplicate_event_ids", "{n} duplicate event identifiers were found"),
    ("unsupported_categories", "{n} unsupported categories were found"),
]


class QualityGateError(RuntimeError):
    def __init__(self, messages: list[str]):
        super().__init__("; ".join(messages))
        self.messages = messages


def quality_counts(events: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Row count, rows missing a required field, event ids seen more than once (ids,
    not rows; a null id is a group of its own) and rows of an unsupported category
    (a null category is not counted here: it is a missing field).

    One pass: aggregate per event id (map-side partial counts, so a hot id costs one
    row per task), then per ``by`` group.
    """
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in GATE_REQUIRED])
    unsupported = ~F.col("category").isin(*SUPPORTED_CATEGORIES)
    per_id = events.groupBy(*by, "event_uuid").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(missing, 1).otherwise(0)).alias("m"),
        F.sum(F.when(unsupported, 1).otherwise(0)).alias("u"),
    )
    return per_id.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("missing_required"),
        F.count_if(F.col("n") > 1).cast("long").alias("duplicate_event_ids"),
        F.coalesce(F.sum("u"), F.lit(0)).cast("long").alias("unsupported_categories"),
    )


def _check_rows(counts: DataFrame, day: F.Column, keep: list[str]) -> DataFrame:
    rows = []
    for order, (name, template) in enumerate(CHECKS):
        n = F.col(name)
        passed = n > 0 if name == "row_count" else n == 0
        if name == "row_count":
            message = F.concat(F.lit(template.split("{day}")[0]), day.cast("string"))
        else:
            message = F.concat(n.cast("string"), F.lit(template.split("{n}")[1]))
        rows.append(
            F.struct(
                F.lit(order).alias("check_order"),
                F.lit(name).alias("check_name"),
                n.alias("observed"),
                passed.alias("passed"),
                F.when(~passed, message).alias("message"),
            )
        )
    return counts.select(*keep, F.explode(F.array(*rows)).alias("c")).select(*keep, "c.*")


def quality_gate(events: DataFrame, run_date: str) -> DataFrame:
    """The four checks for one run date: (check_order, check_name, observed, passed,
    message). The date filter is on the partition column, so only that day is read."""
    day = F.to_date(F.lit(run_date))
    counts = quality_counts(events.filter(F.col("event_date") == day))
    return _check_rows(counts, F.lit(run_date), [])


def quality_gate_by_date(
    events: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The four checks for every day in ``[start, end]`` at once (one job for a backfill).

    A day without rows fails ``row_count``. The calendar is generated from the two
    bounds (one row per day, so its size is the range length) and left-joined.
    """
    if start is None or end is None:
        counts = quality_counts(events, ["event_date"])
    else:
        lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
        # filter before counting: on a date-partitioned table only the range is read
        counts = quality_counts(events.filter(F.col("event_date").between(lo, hi)), ["event_date"])
        days = events.sparkSession.range(1).select(
            F.explode(F.sequence(lo, hi)).alias("event_date")
        )
        counts = days.join(counts, "event_date", "left").na.fill(
            0, ["row_count", "missing_required", "duplicate_event_ids", "unsupported_categories"]
        )
    return _check_rows(counts, F.col("event_date"), ["event_date"])


def failures(gate: DataFrame) -> list[str]:
    """Failure messages in check order (the gate has four rows per day: a bounded collect)."""
    keys = [c for c in ("event_date", "check_order") if c in gate.columns]
    rows = gate.filter(~F.col("passed")).orderBy(*keys).collect()
    return [r["message"] for r in rows]


def run_quality_gate(events: DataFrame, run_date: str) -> int:
    """Raise :class:`QualityGateError` when a check fails; return the day's row count."""
    gate = quality_gate(events, run_date)
    rows = gate.orderBy("check_order").collect()  # four rows
    bad = [r["message"] for r in rows if not r["passed"]]
    if bad:
        raise QualityGateError(bad)
    return int(rows[0]["observed"])
