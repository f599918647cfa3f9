"""Write PLANS.md: the physical plan outline of each job over the production layout.

The curated table is written date-partitioned (as the ingest job writes it), then each
builder runs on ``spark.read`` of it, and the scans (columns read, pushed and
partition filters), exchanges, aggregates, windows and joins of the executed plan are
listed. Usage: python tools/show_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from playpulse.config import JobConfig, build_session, scratch_path  # noqa: E402
from playpulse.operators.engagement import build_daily_engagement  # noqa: E402
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel  # noqa: E402
from playpulse.operators.profile import parse_lines, validation_summary  # noqa: E402
from playpulse.operators.quality import quality_gate  # noqa: E402
from playpulse.operators.retention import (  # noqa: E402
    activity_change,
    activity_of_days,
    build_retention,
    merge_activity,
    player_activity_days,
    retention_of_activity,
)
from playpulse.operators.sessions import build_sessions, session_facts  # noqa: E402
from playpulse.plans.build import curated_at, tables_at  # noqa: E402
from playpulse.plans.replays import index_days, replayed_on  # noqa: E402
from playpulse.sources.fixtures import load_curated, load_json_lines  # noqa: E402
from playpulse.sources.jsonlines import write_json_lines  # noqa: E402
from playpulse.sources.tables import read_table_path, write_table  # noqa: E402
from playpulse.streaming.ingest import ingest  # noqa: E402

KEEP = ("Scan", "Exchange", "Aggregate", "Window", "Join", "Generate", "Expand", "Subquery",
        "TakeOrdered", "Union", "Filter")


def outline(df) -> list[str]:
    df.collect()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    out = []
    for line in plan.split("\n"):
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Location: \S+ \[[^\]]*\]", "", line)
        line = re.sub(r"file:[^,\]\s]*", "<path>", line)
        out.append(line.rstrip()[:260])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    target = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("plans", "local[8]", {"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    table = scratch_path(spark, "plans-events")
    write_table(load_curated(spark, sf_dir, "salt"), "game_events", table, "static")
    ev = read_table_path(spark, table, "game_events")
    lines_path = scratch_path(spark, "plans-json")
    write_json_lines(load_json_lines(spark, sf_dir).repartition(8), lines_path, "gzip")
    parsed_path = scratch_path(spark, "plans-parsed")
    parse_lines(spark.read.text(lines_path)).write.parquet(parsed_path)
    facts = session_facts(ev)
    config = JobConfig(warehouse=scratch_path(spark, "plans-warehouse"), player_salt="salt", catalog="plans_")
    named, tables = curated_at(spark, config), tables_at(spark, config)
    write_table(load_curated(spark, sf_dir, "salt"), "game_events", named, "static")
    bucketed = read_table_path(spark, named, "game_events")
    days = player_activity_days(bucketed, clustered=True)
    write_table(activity_of_days(days), "player_activity", tables["player_activity"], "static")
    masks = read_table_path(spark, tables["player_activity"], "player_activity").where("signup_date = DATE '2024-01-02'")
    on_day = F.col("event_date") == F.lit("2024-01-15").cast("date")
    index_days(spark, config, "2024-01-01", "2024-01-31")
    jobs = {
        "ingest (JSON lines -> curated rows)": ingest(spark.read.text(lines_path), "salt"),
        "daily engagement (session facts, unstaged)": build_daily_engagement(facts, minimum_group_size=20),
        "cohort retention": build_retention(ev, 20),
        "level progression": build_progression_funnel(ev, 20),
        "economy flows": build_economy_flows(ev, 20),
        "quality gate for one day (partition pruning)": quality_gate(ev, "2024-01-15"),
        "sessions of the catalog table in buckets by player": build_sessions(bucketed),
        "player days of the catalog table": days,
        "activity masks merged with a day's change (one signup day)": merge_activity(masks, activity_change(days.where(on_day).limit(0), days.where(on_day))),
        "cohorts of one signup day from its masks": retention_of_activity(masks, 20),
        "event ids of a day that earlier days have": replayed_on(spark, config, "2024-01-15"),
        "validation summary (parsed Parquet copy)": validation_summary(spark.read.parquet(parsed_path), "salt", 20),
    }
    doc = [
        "# Physical plans",
        "",
        f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}` with the curated table",
        "written date-partitioned. Only scans, filters, exchanges, aggregates, windows, joins and",
        "generators are shown (final adaptive plans).",
        "",
    ]
    for name, df in jobs.items():
        doc += [f"## {name}", "", "```"] + outline(df) + ["```", ""]
    with open(target, "w") as f:
        f.write("\n".join(doc))
    spark.stop()


if __name__ == "__main__":
    main()
