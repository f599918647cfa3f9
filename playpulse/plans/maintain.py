"""Maintenance job: merge the small files of the given days of the curated and built tables in place.

The landing table is left to the stream that writes it.
"""

from __future__ import annotations

import datetime as _dt
import sys

from playpulse.config import JobConfig, argument, build_session, default_run_date
from playpulse.plans.build import curated_at, tables_at
from playpulse.sources.compaction import compact_small_files


def main(argv: list[str] | None = None) -> int:
    """``--dates=2024-01-14,2024-01-15`` (default yesterday)."""
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    spark = build_session("playpulse-maintenance")
    dates = argument(argv, "dates", default_run_date()).split(",")
    days = {_dt.date.fromisoformat(d) for d in dates}
    for table, at in {"game_events": curated_at(spark, config), **tables_at(spark, config)}.items():
        merged = compact_small_files(spark, at, table, days)
        print(f"{table}: {sum(merged.values())} small files of {len(merged)} days merged")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
