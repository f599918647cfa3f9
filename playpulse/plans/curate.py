"""Copy days of the landing table into the curated table.

Only the ingest stream writes to the landing table, and no job rewrites it: its readers list
the stream's log, and rows may arrive at any time. The days that are copied are replaced as
a whole, rebalanced into files of the advisory size and sorted for row-group skipping. A day
that the landing table no longer holds stays in the curated table: landed files expire.
"""

from __future__ import annotations

import datetime as _dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playpulse.config import JobConfig, argument, build_session, default_run_date
from playpulse.plans.build import curated_at, landing_at
from playpulse.sources.tables import read_table_path, replace_days


def first_day(run_date: str, config: JobConfig) -> str:
    """The first day that a run for ``run_date`` takes anew."""
    return (_dt.date.fromisoformat(run_date) - _dt.timedelta(days=config.lookback_days)).isoformat()


def curate_days(spark: SparkSession, config: JobConfig, start: str, end: str) -> set[_dt.date]:
    """Copy the days ``start`` .. ``end``; returns those that the landing table holds."""
    landed = read_table_path(spark, landing_at(spark, config), "game_events")
    wanted = F.col("event_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return replace_days(landed.filter(wanted), "game_events", curated_at(spark, config), start, end, drop_missing=False)


def main(argv: list[str] | None = None) -> int:
    """``--start= --end=`` (default: yesterday and the days before it that may have late rows)."""
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    end = argument(argv, "end", default_run_date())
    curate_days(build_session("playpulse-curate"), config, argument(argv, "start", first_day(end, config)), end)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
