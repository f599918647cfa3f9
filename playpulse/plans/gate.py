"""Quality-gate job: ``--run-date=YYYY-MM-DD`` (default yesterday); exit code 1 on failure."""

from __future__ import annotations

import sys

from playpulse.config import JobConfig, argument, build_session, default_run_date
from playpulse.operators.quality import QualityGateError, run_quality_gate
from playpulse.plans.build import curated_at
from playpulse.sources.tables import read_table_path

# The prefixes of the job's output lines.
PASSED = "QUALITY_CHECK_PASSED"
FAILED = "QUALITY_CHECK_FAILED"


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    config = JobConfig.from_env()
    run_date = argument(argv, "run-date", default_run_date())
    spark = build_session("playpulse-quality-gate")
    events = read_table_path(spark, curated_at(spark, config), "game_events")
    try:
        n = run_quality_gate(events, run_date)
    except QualityGateError as e:
        for m in e.messages:
            print(f"{FAILED}: {m}", file=sys.stderr)
        return 1
    print(f"{PASSED}: {n} events validated for {run_date}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
