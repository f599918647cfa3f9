"""Hand-made curated event rows for operator tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from playpulse.schema import TABLE_DDL

CURATED_DEFAULTS = dict(
    event_uuid=None, event_time=None, game_id="g1", session_id="s1", category="user",
    event_id=None, progression_status=None, progression_01=None, progression_02=None,
    progression_03=None, currency=None, amount=None, item_type=None, item_id=None,
    flow_type=None, virtual_currency=None, severity=None, message=None, value=None,
    platform="ios", os_version=None, build="1.0", country_code="US",
    signup_date=dt.date(2024, 1, 1), event_date=None, ingested_at=None, player_key="p1",
)
COLUMNS = list(CURATED_DEFAULTS)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def curated(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Curated rows; event_date defaults to the UTC day of event_time, ids to e<i>."""
    out = []
    for i, r in enumerate(rows):
        d = dict(CURATED_DEFAULTS)
        d["event_uuid"] = f"e{i}"
        d.update(r)
        if d["event_time"] is not None and not isinstance(d["event_time"], dt.datetime):
            d["event_time"] = ts(d["event_time"])
        if d["event_date"] is None and d["event_time"] is not None and "event_date" not in r:
            d["event_date"] = d["event_time"].date()
        out.append(tuple(d[c] for c in COLUMNS))
    return spark.createDataFrame(out, TABLE_DDL["game_events"])
