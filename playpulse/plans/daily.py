"""The gated daily run: curate -> quality gate -> build -> publish -> compact.

A failing step stops the later ones (the gate raises :class:`QualityGateError`).
"""

from __future__ import annotations

import datetime as _dt
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from playpulse.config import JobConfig, argument, build_session, default_run_date
from playpulse.operators.quality import run_quality_gate
from playpulse.plans.build import TABLES, build_and_write, curated_at, tables_at
from playpulse.plans.curate import curate_days, first_day
from playpulse.plans.publish import of_days, publish_all
from playpulse.plans.replays import index_days, replayed_on
from playpulse.schema import SERVING_TABLES, TABLE_PARTITION_COLUMN
from playpulse.sources.compaction import compact_small_files
from playpulse.sources.tables import read_table_path


@dataclass
class DailyResult:
    run_date: str
    events: int
    tables: dict[str, str]
    serving: dict[str, str] = field(default_factory=dict)
    left_out: dict[str, int] = field(default_factory=dict)
    replayed: int | None = None  # event ids of the run date that were sent on an earlier day
    compacted: dict[str, dict[_dt.date, int]] = field(default_factory=dict)  # files merged, by table and day


def run_daily(
    spark: SparkSession,
    config: JobConfig,
    run_date: str,
    version: str | None = None,
    previous_version: str | None = None,
    compact_tables: bool = True,
) -> DailyResult:
    """Run the steps for ``run_date`` and the days before it that may have got late rows.

    The days from ``run_date - lookback_days`` on are copied from the landing table into the
    curated one, gated (``run_date`` alone), rebuilt and published anew, whatever of them
    was published before; days without events stay as they are, and of the cohorts only
    those that the days changed are rebuilt and published. Serving tables are replaced in
    place, partition by partition. With ``version`` the run instead writes new serving version
    directories (the previous run's ``previous_version`` is read for the merge, never
    overwritten). Tables are written compact; only days with several small files are merged.
    """
    days = (first_day(run_date, config), run_date)
    curate_days(spark, config, *days)
    curated = curated_at(spark, config)
    events = read_table_path(spark, curated, "game_events")
    n = run_quality_gate(events, run_date)
    built = build_and_write(
        spark, events, tables_at(spark, config), config.minimum_privacy_group, *days, clustered=config.catalog is not None
    )
    paths = built.paths
    tables = {t: of_days(read_table_path(spark, paths[t], t), t, built.days, built.cohorts) for t in TABLES}
    if version:
        serving = {s: f"{config.serving_path(s)}/{version}" for s in SERVING_TABLES}
        current = (
            {s: f"{config.serving_path(s)}/{previous_version}" for s in serving}
            if previous_version else None
        )
        left_out = publish_all(spark, tables, config, current, serving, built.days, built.cohorts)
    else:
        left_out = publish_all(spark, tables, config, days=built.days, cohorts=built.cohorts)
        serving = {s: config.serving_path(s) for s in SERVING_TABLES}
    result = DailyResult(run_date, n, paths, serving, left_out)
    if config.replay_days is not None:
        index_days(spark, config, *days)
        result.replayed = replayed_on(spark, config, run_date).first()["replayed_ids"]
    if compact_tables:
        # the tables are independent, so they are compacted as concurrent jobs
        targets = {"game_events": curated, **{t: p for t, p in paths.items() if TABLE_PARTITION_COLUMN[t] == "event_date"}}
        with ThreadPoolExecutor(max_workers=len(targets)) as pool:
            futures = {t: pool.submit(compact_small_files, spark, p, t, built.days) for t, p in targets.items()}
            result.compacted = {t: f.result() for t, f in futures.items()}
    return result


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    spark = build_session("playpulse-daily")
    run_date = argument(argv, "run-date", default_run_date())
    version = argument(argv, "version", "") or None
    previous = argument(argv, "previous-version", "") or None
    run_daily(spark, config, run_date, version, previous)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
