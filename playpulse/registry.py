"""Registered queries: each runs a job of the library over the given tables.

``SPARK[name](spark, sf_dir) -> DataFrame`` and ``SQL[name]`` (DuckDB, same column
names) are consumed by ``__spark_entry__.py``, the local checker in
``tools/check_oracle.py`` and ``bench.py``. Timestamps leave as ``timestamp_ntz`` so
both engines compare zone-free values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse import oracle as O
from playpulse.config import JobConfig, scratch_path
from playpulse.functions.privacy import pseudonymize_player_id, suppress_small_groups
from playpulse.functions.rules import is_valid_progression_status
from playpulse.operators import profile as P
from playpulse.operators.bitmaps import dense_ids, distinct_bitmaps, distinct_counts, session_sums
from playpulse.operators.bitmaps import release_view as bitmap_release_view
from playpulse.operators.decode import decode_events
from playpulse.operators.engagement import build_daily_engagement, build_daily_revenue
from playpulse.operators.extras import (
    build_monetization,
    build_placement_exposure,
    build_release_view,
)
from playpulse.operators.funnel import build_economy_flows, build_progression_funnel
from playpulse.operators.quality import quality_gate, quality_gate_by_date
from playpulse.operators.retention import (
    build_retention,
    flags_of_days,
    player_activity_days,
    player_retention_flags,
)
from playpulse.operators.serving import (
    read_serving,
    serving_economy,
    serving_engagement,
    serving_progression,
    serving_retention,
    upsert_by_key,
)
from playpulse.operators.sessions import build_sessions, session_facts
from playpulse.plans.build import TABLES, build_and_write, curated_at, tables_at
from playpulse.plans.curate import curate_days
from playpulse.plans.daily import run_daily
from playpulse.plans.publish import publish_all
from playpulse.plans.replays import index_days, replayed_on
from playpulse.schema import BREAKDOWN_DIMENSIONS, CURATED_EVENT_COLUMNS, SERVING_DDL, serving_primary_key
from playpulse.sources.fixtures import (
    curated_events,
    envelope_to_json,
    events_to_envelope,
    load_curated,
    load_json_lines,
    read_table,
)
from playpulse.sources.compaction import compact_small_files
from playpulse.sources.files import exists
from playpulse.sources.jsonlines import read_json_lines, write_json_lines
from playpulse.sources.serving import ALL, publish, read_serving_table
from playpulse.sources.tables import (
    MANY_FILES,
    compact,
    compact_partitions,
    days_between,
    drop_partitions,
    ensure_table,
    read_many_files,
    read_table_path,
    write_partitioned,
    write_table,
)
from playpulse.streaming.ingest import ingest, ingest_writer, read_json_stream, start_ingest, state_partitions
from playpulse.streaming.metrics import recorded

# Salt used for the fixture runs (jobs take theirs from configuration).
FIXTURE_SALT = "fixture-salt"

# Privacy thresholds per query: chosen so that at sf0.01 some groups stay and some go.
MIN_ENGAGEMENT = 20
MIN_RETENTION = 10
MIN_FUNNEL = 2
MIN_ECONOMY = 5
MIN_LEVEL_STARTS = 75
MIN_EXTRA = 5
PRIVACY_EVENTS = 180
GATE_RUN_DATE = "2024-01-15"

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def zone_free(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (UTC wall clock)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return zone_free(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        SPARK[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _cur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_curated(spark, sf_dir, FIXTURE_SALT)


CUR = O.curated_cte(FIXTURE_SALT)


# ---- A1 sessions -------------------------------------------------------------------
@register("player_sessions", f"{CUR} {O.sessions_body()}")
def q_player_sessions(spark, sf_dir):
    return build_sessions(_cur(spark, sf_dir))


# ---- A2 revenue --------------------------------------------------------------------
@register("daily_revenue", f"{CUR} {O.revenue_body()}")
def q_daily_revenue(spark, sf_dir):
    return build_daily_revenue(_cur(spark, sf_dir))


# ---- A3 engagement (fused single scan) and the two-input join form -------------------
@register(
    "daily_engagement",
    f"{CUR}, s AS ({O.sessions_body()}) {O.engagement_body(MIN_ENGAGEMENT)}",
)
def q_daily_engagement(spark, sf_dir):
    return build_daily_engagement(session_facts(_cur(spark, sf_dir)), minimum_group_size=MIN_ENGAGEMENT)


@register(
    "daily_engagement_join",
    f"{CUR}, s AS ({O.sessions_body()}) {O.engagement_body(MIN_ENGAGEMENT, null_safe=False)}",
)
def q_daily_engagement_join(spark, sf_dir):
    ev = _cur(spark, sf_dir)
    return build_daily_engagement(
        build_sessions(ev), ev, minimum_group_size=MIN_ENGAGEMENT, null_safe_dimensions=False
    )


# ---- A4-A6 retention ---------------------------------------------------------------
@register("player_retention_flags", f"{CUR} {O.retention_flags_body()}")
def q_player_retention_flags(spark, sf_dir):
    return player_retention_flags(_cur(spark, sf_dir))


@register("cohort_retention", f"{CUR} {O.retention_body(MIN_RETENTION)}")
def q_cohort_retention(spark, sf_dir):
    return build_retention(_cur(spark, sf_dir), MIN_RETENTION)


# ---- A7 funnel, A8 economy -----------------------------------------------------------
@register("level_progression", f"{CUR} {O.funnel_body(MIN_FUNNEL)}")
def q_level_progression(spark, sf_dir):
    return build_progression_funnel(_cur(spark, sf_dir), MIN_FUNNEL)


@register("economy_flows", f"{CUR} {O.economy_body(MIN_ECONOMY)}")
def q_economy_flows(spark, sf_dir):
    return build_economy_flows(_cur(spark, sf_dir), MIN_ECONOMY)


# ---- C1 quality gate (A9-A12, P9-P11) ------------------------------------------------
@register("quality_gate_by_date", f"{CUR} {O.gate_body('cur')}")
def q_quality_gate_by_date(spark, sf_dir):
    return quality_gate_by_date(_cur(spark, sf_dir))


@register("quality_gate", f"{CUR} {O.gate_body('cur', GATE_RUN_DATE)}")
def q_quality_gate(spark, sf_dir):
    return quality_gate(_cur(spark, sf_dir), GATE_RUN_DATE)


@register(
    "quality_gate_untranslated",
    f"{O.curated_cte(FIXTURE_SALT).replace(O.CATEGORY_CASE, 'event_type AS category')} {O.gate_body('cur')}",
)
def q_quality_gate_untranslated(spark, sf_dir):
    ev = curated_events(read_table(spark, sf_dir, "events"), FIXTURE_SALT, translate_categories=False)
    return quality_gate_by_date(ev)


def _replayed_lines(spark, sf_dir):
    """The JSON export delivered twice (at-least-once replay of the whole export)."""
    lines = load_json_lines(spark, sf_dir)
    return lines.unionByName(lines)


REPLAYED_CUR = f"""{CUR},
    replay AS (SELECT * FROM cur UNION ALL SELECT * FROM cur)"""


@register("quality_gate_replayed", f"{REPLAYED_CUR} {O.gate_body('replay')}")
def q_quality_gate_replayed(spark, sf_dir):
    """The gate over a replayed delivery ingested without dedup: every id twice."""
    landed = ingest(_replayed_lines(spark, sf_dir), FIXTURE_SALT, dedup="none")
    return quality_gate_by_date(landed)


# ---- C5 file validation profile (P20, A13-A21, T1-T3) ---------------------------------
def _parsed(spark, sf_dir):
    return P.parse_lines(load_json_lines(spark, sf_dir))


VALID = O.valid_cte()


@register("file_profile", f"{VALID} {O.file_profile_body()}")
def q_file_profile(spark, sf_dir):
    return P.file_profile(_parsed(spark, sf_dir))


@register(
    "duplicate_measures",
    f"""{VALID}, v2 AS (SELECT * FROM v UNION ALL SELECT * FROM v),
    per_id AS (SELECT event_uuid, count(*) AS n FROM v2 GROUP BY event_uuid)
    SELECT count(*) FILTER (WHERE n > 1) AS duplicate_ids,
           CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeat_occurrences FROM per_id""",
)
def q_duplicate_measures(spark, sf_dir):
    return P.duplicate_measures(P.parse_lines(_replayed_lines(spark, sf_dir)))


@register("category_counts", f"{VALID} SELECT category, count(*) AS events FROM v GROUP BY category")
def q_category_counts(spark, sf_dir):
    return P.category_counts(_parsed(spark, sf_dir))


@register(
    "error_session_rate",
    f"""{VALID} SELECT *, {O.pct('error_sessions', 'sessions')} AS error_session_rate_percent FROM (
      SELECT count(DISTINCT CASE WHEN category = 'error' THEN session_id END) AS error_sessions,
             count(DISTINCT session_id) AS sessions FROM v)""",
)
def q_error_session_rate(spark, sf_dir):
    return P.error_session_rate(_parsed(spark, sf_dir))


@register(
    "total_revenue",
    f"""{VALID} SELECT c AS revenue_cents, round(CAST(c AS DOUBLE) / 100.0, 2) AS revenue_usd FROM (
      SELECT CAST(coalesce(sum(CASE WHEN category = 'business' THEN coalesce(amount, 0) ELSE 0 END), 0)
             AS BIGINT) AS c FROM v)""",
)
def q_total_revenue(spark, sf_dir):
    return P.total_revenue(_parsed(spark, sf_dir))


@register("eligible_retention", f"{VALID} {O.eligible_retention_body()}")
def q_eligible_retention(spark, sf_dir):
    return P.eligible_retention(_parsed(spark, sf_dir))


@register("level_event_counts", f"{VALID} {O.level_counts_body()}")
def q_level_event_counts(spark, sf_dir):
    return P.level_counts(_parsed(spark, sf_dir))


@register("hardest_levels", f"{VALID} {O.hardest_levels_body(MIN_LEVEL_STARTS)}")
def q_hardest_levels(spark, sf_dir):
    return P.hardest_levels(_parsed(spark, sf_dir), MIN_LEVEL_STARTS)


@register("sample_player_keys", f"{VALID} {O.sample_keys_body(FIXTURE_SALT)}")
def q_sample_player_keys(spark, sf_dir):
    return P.sample_player_keys(_parsed(spark, sf_dir), FIXTURE_SALT)


@register("suppressed_privacy_groups", f"{VALID} {O.privacy_groups_body(PRIVACY_EVENTS)}")
def q_suppressed_privacy_groups(spark, sf_dir):
    return P.suppressed_privacy_groups(_parsed(spark, sf_dir), PRIVACY_EVENTS)


@register("validate_json_files", f"{VALID} {O.summary_body(FIXTURE_SALT, MIN_LEVEL_STARTS)}")
def q_validate_json_files(spark, sf_dir):
    """The validation job end to end: the events exported as gzip JSON-lines files, then
    parsed once into Parquet and profiled."""
    from playpulse.plans.validate import profile_files

    path = scratch_path(spark, "export-json")
    lines = load_json_lines(spark, sf_dir)
    write_json_lines(lines.repartition(max(spark.sparkContext.defaultParallelism, 1)), path, "gzip")
    return profile_files(spark, path, FIXTURE_SALT, MIN_LEVEL_STARTS)


@register("validation_summary", f"{VALID} {O.summary_body(FIXTURE_SALT, MIN_LEVEL_STARTS)}")
def q_validation_summary(spark, sf_dir):
    return P.validation_summary(_parsed(spark, sf_dir), FIXTURE_SALT, MIN_LEVEL_STARTS)


# ---- R6 ingest: batch, stream with replayed delivery, both dedup modes ----------------
NO_INGEST_TIME = [c for c in CURATED_EVENT_COLUMNS if c != "ingested_at"]
CURATED_SQL = f"{CUR} SELECT * FROM cur"


@register("ingest_batch", CURATED_SQL)
def q_ingest_batch(spark, sf_dir):
    return ingest(load_json_lines(spark, sf_dir), FIXTURE_SALT).select(*NO_INGEST_TIME)


def _replayed_stream(spark, sf_dir):
    """The events file as a stream, delivered twice (at-least-once replay)."""
    schema = read_table(spark, sf_dir, "events").schema

    def one():
        src = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
        return envelope_to_json(events_to_envelope(src.parquet(sf_dir)))

    return one().unionByName(one())


def _run_stream(spark, sf_dir, dedup):
    out, ck = scratch_path(spark, "ingest-out"), scratch_path(spark, "ingest-ck")
    curated = ingest(_replayed_stream(spark, sf_dir), FIXTURE_SALT, dedup=dedup)
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = ingest_writer(curated, ck, available_now=True).start(out)
    query.awaitTermination()
    return spark.read.parquet(out).select(*NO_INGEST_TIME)


@register("ingest_stream_dedup", CURATED_SQL)
def q_ingest_stream_dedup(spark, sf_dir):
    return _run_stream(spark, sf_dir, "watermark")


@register("ingest_stream_state_dedup", CURATED_SQL)
def q_ingest_stream_state_dedup(spark, sf_dir):
    return _run_stream(spark, sf_dir, "state")


@register("ingest_stream_file_batches", CURATED_SQL)
def q_ingest_stream_file_batches(spark, sf_dir):
    """The export landed twice as several JSON-lines files and consumed one file per
    micro-batch: copies arrive in different batches and are caught by the dedup
    state. The watermark delay (45 days) exceeds the data's 30-day span, so no row is
    late whatever order the files are read in, and the result equals the batch table."""
    landing = scratch_path(spark, "landing")
    lines = load_json_lines(spark, sf_dir).repartition(4)
    write_json_lines(lines, landing)
    write_json_lines(lines, landing, mode="append")  # the replayed delivery
    out, ck = scratch_path(spark, "ingest-out"), scratch_path(spark, "ingest-ck")
    stream = read_json_stream(spark, landing, max_files_per_trigger=1)
    curated = ingest(stream, FIXTURE_SALT, dedup="watermark", watermark="45 days")
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = ingest_writer(curated, ck, available_now=True).start(out)
    query.awaitTermination()
    return spark.read.parquet(out).select(*NO_INGEST_TIME)


# ---- K5 JSON-lines files: write gzip lines, scan and decode ------------------------------
@register(
    "json_lines_scan",
    f"WITH env AS ({O.envelope_sql()}) SELECT * FROM env",
)
def q_json_lines_scan(spark, sf_dir):
    path = scratch_path(spark, "json-lines")
    write_json_lines(load_json_lines(spark, sf_dir), path, compression="gzip")
    return decode_events(read_json_lines(spark, path))


# ---- P7 / P8 as plain operators --------------------------------------------------------
@register(
    "pseudonymize",
    f"WITH env AS ({O.envelope_sql()}) "
    f"SELECT event_uuid, sha256('{FIXTURE_SALT}' || coalesce(user_id, 'missing')) AS player_key FROM env",
)
def q_pseudonymize(spark, sf_dir):
    env = events_to_envelope(read_table(spark, sf_dir, "events"))
    return pseudonymize_player_id(env, FIXTURE_SALT).select("event_uuid", "player_key")


@register(
    "suppress_small_groups",
    f"""{CUR} SELECT * FROM (SELECT game_id, event_date, country_code,
          count(DISTINCT player_key) AS players FROM cur GROUP BY ALL)
        WHERE players >= {MIN_ENGAGEMENT}""",
)
def q_suppress_small_groups(spark, sf_dir):
    players = _cur(spark, sf_dir).groupBy("game_id", "event_date", "country_code").agg(
        F.countDistinct("player_key").alias("players")
    )
    return suppress_small_groups(players, "players", MIN_ENGAGEMENT)


# ---- P14-P17 serving shapes -----------------------------------------------------------
def _engagement_serving_sql(min_group: int, src: str = "cur") -> str:
    body = O.engagement_body(min_group).replace("FROM cur", f"FROM {src}")
    return f"""SELECT game_id, strftime(event_date, '%Y-%m') AS activity_month,
          event_date AS activity_date, platform, build, country_code, dau, sessions,
          avg_session_seconds, p95_session_seconds, crash_free_session_rate, revenue_usd
        FROM ({body})"""


SESSIONS_CTE = f"{CUR}, s AS ({O.sessions_body()})"
SERVING_ENGAGEMENT_BODY = _engagement_serving_sql(MIN_ENGAGEMENT)
SERVING_ENGAGEMENT_SQL = f"{SESSIONS_CTE} {SERVING_ENGAGEMENT_BODY}"


@register("serving_engagement", SERVING_ENGAGEMENT_SQL)
def q_serving_engagement(spark, sf_dir):
    ev = _cur(spark, sf_dir)
    return serving_engagement(build_daily_engagement(session_facts(ev), minimum_group_size=MIN_ENGAGEMENT))


@register(
    "serving_retention",
    f"""{CUR} SELECT game_id, strftime(cohort_date, '%Y-%m') AS cohort_month, cohort_date,
          platform, build, country_code, cohort_size, retained_d1_players, retained_d7_players,
          retained_d30_players, d1_retention, d7_retention, d30_retention
        FROM ({O.retention_body(MIN_RETENTION)})""",
)
def q_serving_retention(spark, sf_dir):
    return serving_retention(build_retention(_cur(spark, sf_dir), MIN_RETENTION))


@register("serving_progression", f"{CUR} {O.funnel_body(MIN_FUNNEL)}")
def q_serving_progression(spark, sf_dir):
    return serving_progression(build_progression_funnel(_cur(spark, sf_dir), MIN_FUNNEL))


@register("serving_economy", f"{CUR} {O.economy_body(MIN_ECONOMY)}")
def q_serving_economy(spark, sf_dir):
    return serving_economy(build_economy_flows(_cur(spark, sf_dir), MIN_ECONOMY))


# ---- K9 / J4 upsert: re-publishing recent days over an earlier, partial publication ------
UPSERT_CUTOFF = "2024-01-20 12:00:00"  # the earlier publication saw events up to here
UPSERT_FROM = "2024-01-20"  # the re-publication recomputes this day onward

ENGAGEMENT_KEY = "game_id, activity_month, activity_date, platform, build, country_code"


def _serving_engagement_of(events):
    return serving_engagement(
        build_daily_engagement(session_facts(events), minimum_group_size=MIN_ENGAGEMENT)
    )


@register(
    "upsert_by_key",
    f"""{CUR},
    early AS (SELECT * FROM cur WHERE event_time < TIMESTAMP '{UPSERT_CUTOFF}'),
    late AS (SELECT * FROM cur WHERE event_date >= DATE '{UPSERT_FROM}'),
    s_early AS ({O.sessions_body().replace("FROM cur", "FROM early")}),
    s_late AS ({O.sessions_body().replace("FROM cur", "FROM late")}),
    existing AS ({_engagement_serving_sql(MIN_ENGAGEMENT).replace("FROM s ", "FROM s_early ").replace("FROM cur", "FROM early")}),
    updates AS ({_engagement_serving_sql(MIN_ENGAGEMENT).replace("FROM s ", "FROM s_late ").replace("FROM cur", "FROM late")})
    SELECT e.* FROM existing e ANTI JOIN updates u USING ({ENGAGEMENT_KEY})
    UNION ALL SELECT * FROM updates""",
)
def q_upsert_by_key(spark, sf_dir):
    ev = _cur(spark, sf_dir)
    existing = _serving_engagement_of(ev.filter(F.col("event_time") < F.lit(UPSERT_CUTOFF).cast("timestamp")))
    updates = _serving_engagement_of(ev.filter(F.col("event_date") >= F.lit(UPSERT_FROM).cast("date")))
    staged = scratch_path(spark, "upsert")  # both sides of the merge read the updates
    updates.write.parquet(staged)
    return upsert_by_key(existing, spark.read.schema(updates.schema).parquet(staged), "daily_engagement_by_game_day")


# ---- K10 / T4 keyed read ------------------------------------------------------------
READ_GAME, READ_MONTH = "game-0", "2024-01"


@register(
    "serving_read",
    f"""{SESSIONS_CTE} SELECT * FROM ({SERVING_ENGAGEMENT_BODY})
    WHERE game_id = '{READ_GAME}' AND activity_month = '{READ_MONTH}'""",
)
def q_serving_read(spark, sf_dir):
    rows = q_serving_engagement(spark, sf_dir)
    return read_serving(rows, "daily_engagement_by_game_day", READ_GAME, READ_MONTH)


READ_DAY = "2024-01-15"


@register(
    "serving_read_day",
    f"""{CUR} SELECT * FROM ({O.funnel_body(MIN_FUNNEL)})
    WHERE game_id = '{READ_GAME}' AND event_date = DATE '{READ_DAY}'""",
)
def q_serving_read_day(spark, sf_dir):
    rows = serving_progression(build_progression_funnel(_cur(spark, sf_dir), MIN_FUNNEL))
    return read_serving(rows, "level_progression_by_game_day", READ_GAME, READ_DAY)


@register(
    "serving_read_published",
    f"""{SESSIONS_CTE} SELECT * FROM ({_engagement_serving_sql(MIN_ECONOMY)})
    WHERE game_id = '{READ_GAME}' AND activity_month = '{READ_MONTH}'""",
)
def q_serving_read_published(spark, sf_dir):
    """A game's month read from the published table, through its order and Bloom filters."""
    table = "daily_engagement_by_game_day"
    return read_serving(_published(table)(spark, sf_dir), table, READ_GAME, READ_MONTH)


@register(
    "keyed_store_deletions",
    f"""{SESSIONS_CTE}, wide AS ({_engagement_serving_sql(1)}), narrow AS ({_engagement_serving_sql(MIN_ENGAGEMENT)})
    SELECT {ENGAGEMENT_KEY} FROM wide ANTI JOIN narrow USING ({ENGAGEMENT_KEY})""",
)
def q_keyed_store_deletions(spark, sf_dir):
    """Engagement published to a keyed store, then again under a higher privacy threshold: the keys
    sent for deletion are those of the groups below it."""
    store, deleted = scratch_path(spark, "store"), scratch_path(spark, "deleted")
    config = JobConfig(
        warehouse=scratch_path(spark, "warehouse"), serving_format="json", serving_options={"path": store}, serving_delete_options={"path": deleted}
    )
    table, facts = "daily_engagement_by_game_day", session_facts(_cur(spark, sf_dir))
    for minimum in (1, MIN_ENGAGEMENT):
        publish(spark, serving_engagement(build_daily_engagement(facts, minimum_group_size=minimum)), table, config, replace=ALL)
    # a store that was sent no deletion has no folder
    sent = spark.read.schema(SERVING_DDL[table]).json(deleted) if exists(spark, deleted) else spark.createDataFrame([], SERVING_DDL[table])
    return sent.select(*serving_primary_key(table))


# ---- K6 dynamic partition overwrite, K11 compaction ----------------------------------
OVERWRITE_CUTOFF = "2024-01-25 12:00:00"
OVERWRITE_FROM = "2024-01-25"


@register("partition_overwrite", f"{CUR} {O.sessions_body()}")
def q_partition_overwrite(spark, sf_dir):
    """Sessions written from events up to a cutoff, then the days from the cutoff day
    on recomputed and written with dynamic overwrite: earlier days must survive and the
    partial day must be replaced."""
    ev = _cur(spark, sf_dir)
    path = scratch_path(spark, "player-sessions")
    early = ev.filter(F.col("event_time") < F.lit(OVERWRITE_CUTOFF).cast("timestamp"))
    late = ev.filter(F.col("event_date") >= F.lit(OVERWRITE_FROM).cast("date"))
    write_table(build_sessions(early), "player_sessions", path, mode="static")
    write_table(build_sessions(late), "player_sessions", path, mode="dynamic")
    return spark.read.parquet(path)


def _small_files(spark, sf_dir, rows):
    """The curated table as a new folder of files of few rows."""
    path = scratch_path(spark, "events-small")
    write_partitioned(_cur(spark, sf_dir), path, "event_date", "static", max_records_per_file=rows, options=MANY_FILES)
    return path


@register("compact_table", CURATED_SQL)
def q_compact_table(spark, sf_dir):
    """The curated table written as many small files, then compacted to a new path."""
    src, dst = _small_files(spark, sf_dir, 50), scratch_path(spark, "events-compact")
    return compact(spark, src, dst, "event_date").select(*NO_INGEST_TIME)


@register("compact_small_files", CURATED_SQL)
def q_compact_small_files(spark, sf_dir):
    """The curated table written as many small files; those of ten days merged, twice (the second
    run finds nothing to do); the whole table read back."""
    path = _small_files(spark, sf_dir, 20)
    days = days_between("2024-01-10", "2024-01-19")
    compact_small_files(spark, path, "game_events", days)
    if compact_small_files(spark, path, "game_events", days):
        raise AssertionError("there was nothing left to merge")
    return read_many_files(spark, path, "game_events").select(*NO_INGEST_TIME)


@register("compact_partitions", CURATED_SQL)
def q_compact_partitions(spark, sf_dir):
    """The curated table written as many small files; ten days of it compacted in
    place; the whole table read back."""
    import datetime as _dt

    path = _small_files(spark, sf_dir, 50)
    days = [(_dt.date(2024, 1, 10) + _dt.timedelta(days=i)).isoformat() for i in range(10)]
    compact_partitions(spark, path, "event_date", days, table="game_events")
    return spark.read.parquet(path).select(*NO_INGEST_TIME)


# ---- C4 gated daily run -------------------------------------------------------------
DAILY_FIRST_DATE, DAILY_RUN_DATE, DAILY_NEXT_DATE = "2024-01-14", "2024-01-15", "2024-01-16"


def _landed(spark, events, minimum, **more):
    """A new warehouse with the events in its landing table."""
    config = JobConfig(warehouse=scratch_path(spark, "warehouse"), player_salt=FIXTURE_SALT, minimum_privacy_group=minimum, **more)
    ensure_table(spark, config.table_at(config.raw_table), "game_events", config.table_path(config.raw_table), buckets=0)
    write_table(events, "game_events", config.table_at(config.raw_table), "append")
    return config


def _named():
    """Settings that put all tables into databases of their own in the session's catalog."""
    return {"catalog": f"w{uuid.uuid4().hex[:10]}_"}


@register(
    "daily_run",
    f"""{SESSIONS_CTE} SELECT * FROM ({SERVING_ENGAGEMENT_BODY})
    WHERE activity_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_RUN_DATE}'""",
)
def q_daily_run(spark, sf_dir):
    """Land the events, then curate -> gate -> build -> publish -> compact for one day;
    returns the engagement rows published for it and for the day before, taken anew."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT)
    result = run_daily(spark, config, DAILY_RUN_DATE)  # serving replaced in place
    table = "daily_engagement_by_game_day"
    return read_serving_table(spark, result.serving[table], table)


@register(
    "daily_rerun_suppressed",
    f"""{SESSIONS_CTE} SELECT * FROM ({SERVING_ENGAGEMENT_BODY})
    WHERE activity_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_RUN_DATE}'""",
)
def q_daily_rerun_suppressed(spark, sf_dir):
    """A day run without a privacy threshold, then again with one: groups below it are gone
    from the analytical and from the serving table (the rows that both hold are returned)."""
    config = _landed(spark, _cur(spark, sf_dir), 1)
    run_daily(spark, config, DAILY_RUN_DATE)
    result = run_daily(spark, replace(config, minimum_privacy_group=MIN_ENGAGEMENT), DAILY_RUN_DATE)
    table = "daily_engagement_by_game_day"
    built = serving_engagement(read_table_path(spark, result.tables["daily_engagement"], "daily_engagement"))
    published = read_serving_table(spark, result.serving[table], table)
    return published.unionByName(built).distinct()


DAILY_SQL = f"""{SESSIONS_CTE} SELECT * FROM ({SERVING_ENGAGEMENT_BODY})
    WHERE activity_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_RUN_DATE}'"""


@register("daily_run_on_names", DAILY_SQL)
def q_daily_run_on_names(spark, sf_dir):
    """The daily run with all tables in the catalog: landing, curated and built tables are
    addressed by name alone, bucketed, written with insertInto."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT, **_named())
    result = run_daily(spark, config, DAILY_RUN_DATE)
    table = "daily_engagement_by_game_day"
    return read_serving_table(spark, result.serving[table], table)


@register("curated_by_name", f"{CUR} SELECT * FROM cur WHERE event_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_NEXT_DATE}'")
def q_curated_by_name(spark, sf_dir):
    """Days curated into a bucketed catalog table in two runs that overlap by a day, compacted, read by name."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT, **_named())
    curate_days(spark, config, DAILY_FIRST_DATE, DAILY_RUN_DATE)
    days = curate_days(spark, config, DAILY_RUN_DATE, DAILY_NEXT_DATE)
    at = curated_at(spark, config)
    compact_small_files(spark, at, "game_events", days)
    return spark.table(str(at)).select(*NO_INGEST_TIME)


@register("sessions_of_buckets", f"{CUR} {O.sessions_body()}")
def q_sessions_of_buckets(spark, sf_dir):
    """Sessions from the curated table in buckets by player: no shuffle between scan and result."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT, **_named())
    at = curated_at(spark, config)
    write_table(_cur(spark, sf_dir), "game_events", at, "static")
    return build_sessions(read_table_path(spark, at, "game_events"))


@register("player_flags_of_buckets", f"{CUR} {O.retention_flags_body()}")
def q_player_flags_of_buckets(spark, sf_dir):
    """Player days and retention flags from bucketed tables, both steps without a shuffle."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT, **_named())
    at, tables = curated_at(spark, config), tables_at(spark, config)
    write_table(_cur(spark, sf_dir), "game_events", at, "static")
    days = player_activity_days(read_table_path(spark, at, "game_events"), clustered=True)
    write_table(days, "player_days", tables["player_days"], "static")
    return flags_of_days(read_table_path(spark, tables["player_days"], "player_days"))


@register("daily_rerun_after_expiry", DAILY_SQL)
def q_daily_rerun_after_expiry(spark, sf_dir):
    """A day run, run again after the landing table has lost the day before it: what was curated,
    built and published of that day stays."""
    config = _landed(spark, _cur(spark, sf_dir), MIN_ENGAGEMENT)
    run_daily(spark, config, DAILY_RUN_DATE)
    drop_partitions(spark, config.table_at(config.raw_table), "event_date", days_between(DAILY_FIRST_DATE, DAILY_FIRST_DATE))
    result = run_daily(spark, config, DAILY_RUN_DATE)
    table = "daily_engagement_by_game_day"
    built = serving_engagement(read_table_path(spark, result.tables["daily_engagement"], "daily_engagement"))
    return read_serving_table(spark, result.serving[table], table).unionByName(built).distinct()


# ---- A4-A6 by activity masks ---------------------------------------------------------------
STEPS = [("2024-01-11", "2024-01-13"), ("2024-01-14", "2024-01-20"), ("2024-01-19", "2024-01-31")]


@register("cohorts_day_by_day", f"{CUR} {O.retention_body(MIN_RETENTION)}")
def q_cohorts_day_by_day(spark, sf_dir):
    """The first ten days built whole, the others range by range (two ranges overlap, part of a
    day lands late): cohorts from merged activity masks are those of all events."""
    events = _cur(spark, sf_dir)
    base = scratch_path(spark, "warehouse")
    paths = {t: f"{base}/{t}" for t in TABLES}
    early = events.filter(F.col("event_time") < F.lit("2024-01-19 12:00:00").cast("timestamp"))
    build_and_write(spark, early.filter(F.col("event_date") <= F.lit("2024-01-10").cast("date")), paths, MIN_RETENTION)
    for i, (start, end) in enumerate(STEPS):
        build_and_write(spark, events if i == len(STEPS) - 1 else early, paths, MIN_RETENTION, start, end)
    return read_table_path(spark, paths["cohort_retention"], "cohort_retention")


# ---- A11 A14 G2 across days ------------------------------------------------------------------
REPLAYED = "CAST(substr(event_uuid, 3) AS BIGINT) % 40 = 0"


@register(
    "replayed_ids",
    f"""{CUR}, sent AS (SELECT event_uuid, event_date FROM cur UNION ALL
      SELECT event_uuid, CAST(event_date + INTERVAL 2 DAY AS DATE) FROM cur WHERE {REPLAYED} UNION ALL
      SELECT event_uuid, CAST(event_date + INTERVAL 2 DAY AS DATE) FROM cur WHERE {REPLAYED}),
    firsts AS (SELECT event_uuid, min(event_date) AS first_date FROM sent GROUP BY 1),
    again AS (SELECT sent.* FROM sent JOIN firsts USING (event_uuid) WHERE first_date < event_date)
    SELECT d.event_date, count(DISTINCT event_uuid) AS replayed_ids, count(event_uuid) AS replayed_rows
    FROM (SELECT CAST(unnest(range(DATE '{DAILY_FIRST_DATE}', DATE '{DAILY_NEXT_DATE}' + 1, INTERVAL 1 DAY)) AS DATE) AS event_date) d
      LEFT JOIN again USING (event_date) GROUP BY 1""",
)
def q_replayed_ids(spark, sf_dir):
    """Some ids are sent again, twice, two days later, past the ingest's watermark: the index of id
    hashes tells how many of a day's ids earlier days had."""
    events = _cur(spark, sf_dir)
    again = events.filter(F.expr(REPLAYED)).withColumns(
        {"event_time": F.col("event_time") + F.expr("INTERVAL 2 DAYS"), "event_date": F.date_add("event_date", 2)}
    )
    sent = events.unionByName(again).unionByName(again)
    config = _landed(spark, sent, MIN_ENGAGEMENT, replay_days=0, **_named())
    curate_days(spark, config, "2024-01-01", "2024-02-28")
    index_days(spark, config, "2024-01-01", "2024-02-28")
    days = [d.isoformat() for d in days_between(DAILY_FIRST_DATE, DAILY_NEXT_DATE)]
    return reduce(DataFrame.unionByName, [replayed_on(spark, config, d) for d in days])


LATE_CUTOFF = "2024-01-15 08:00:00"  # what had landed when the first day was run


LATE_DAYS = f"{CUR}, days AS (SELECT * FROM cur WHERE event_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_NEXT_DATE}')"
LATE_SQL = {
    "player_sessions": O.sessions_body(),
    "daily_engagement": f", s AS ({O.sessions_body()}) {O.engagement_body(MIN_FUNNEL)}",
    "level_progression": O.funnel_body(MIN_FUNNEL),
    "economy_flows": O.economy_body(MIN_FUNNEL),
}


def _late(table):
    """A day run while part of it is still to land, the rest appended, the next day run: the
    table's rows of all days that the two runs took are those of a full build."""

    def run(spark, sf_dir):
        events = _cur(spark, sf_dir)
        early = F.col("event_time") < F.lit(LATE_CUTOFF).cast("timestamp")
        config = _landed(spark, events.filter(early), MIN_FUNNEL)
        run_daily(spark, config, DAILY_RUN_DATE)
        write_table(events.filter(~early), "game_events", config.table_path(config.raw_table), "append")
        result = run_daily(spark, config, DAILY_NEXT_DATE)
        return read_table_path(spark, result.tables[table], table)

    return run


for _name, _sql in LATE_SQL.items():
    register(f"daily_run_late_{_name}", f"{LATE_DAYS} {_sql.replace('FROM cur', 'FROM days')}")(_late(_name))


@register(
    "stream_then_daily",
    f"{CUR} SELECT * FROM cur WHERE event_date BETWEEN DATE '{DAILY_FIRST_DATE}' AND DATE '{DAILY_NEXT_DATE}'",
)
def q_stream_then_daily(spark, sf_dir):
    """The ingest stream lands the export, two days are run one after the other with
    compaction; returns the curated table, which later reads still find whole."""
    landing, warehouse = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    write_json_lines(load_json_lines(spark, sf_dir), landing)
    config = JobConfig(
        warehouse=warehouse, player_salt=FIXTURE_SALT, minimum_privacy_group=MIN_ENGAGEMENT,
        checkpoint_location=scratch_path(spark, "ingest-ck"), state_partitions=spark.sparkContext.defaultParallelism,
    )
    start_ingest(read_json_stream(spark, landing), config, available_now=True).awaitTermination()
    run_daily(spark, config, DAILY_RUN_DATE)
    run_daily(spark, config, DAILY_NEXT_DATE)
    return read_table_path(spark, config.table_path(config.curated_table), "game_events").select(*NO_INGEST_TIME)


# ---- C2 build, C3 publish: every table of a full build and publication --------------------
def _full_build(spark, sf_dir):
    config = JobConfig(warehouse=scratch_path(spark, "warehouse"), player_salt=FIXTURE_SALT, minimum_privacy_group=MIN_ECONOMY)
    paths = {t: config.table_path(t) for t in TABLES}
    build_and_write(spark, _cur(spark, sf_dir), paths, MIN_ECONOMY)
    return config, {t: read_table_path(spark, p, t) for t, p in paths.items()}


def _built(table):
    return lambda spark, sf_dir: _full_build(spark, sf_dir)[1][table]


def _published(table):
    def run(spark, sf_dir):
        config, tables = _full_build(spark, sf_dir)
        publish_all(spark, tables, config)
        return read_serving_table(spark, config.serving_path(table), table)

    return run


BUILT_SQL = {
    "player_sessions": f"{CUR} {O.sessions_body()}",
    "daily_engagement": f"{SESSIONS_CTE} {O.engagement_body(MIN_ECONOMY)}",
    "cohort_retention": f"{CUR} {O.retention_body(MIN_ECONOMY)}",
    "level_progression": f"{CUR} {O.funnel_body(MIN_ECONOMY)}",
    "economy_flows": f"{CUR} {O.economy_body(MIN_ECONOMY)}",
}
for _name, _sql in BUILT_SQL.items():
    register(f"built_{_name}", _sql)(_built(_name))
PUBLISHED_SQL = {
    "daily_engagement_by_game_day": f"{SESSIONS_CTE} {_engagement_serving_sql(MIN_ECONOMY)}",
    "cohort_retention_by_game_day": f"""{CUR} SELECT strftime(cohort_date, '%Y-%m') AS cohort_month, *
        FROM ({O.retention_body(MIN_ECONOMY)})""",
    "level_progression_by_game_day": BUILT_SQL["level_progression"],
    "economy_flows_by_game_day": BUILT_SQL["economy_flows"],
}
for _name, _sql in PUBLISHED_SQL.items():
    register(f"published_{_name}", _sql)(_published(_name))


# ---- input that fails checks, injected on both sides --------------------------------------
def _changed(events: DataFrame, changes: dict[str, str]) -> DataFrame:
    """``events`` with columns replaced by SQL over ``n``, the number in the event id."""
    n = events.withColumn("n", F.substring("event_uuid", 3, 18).cast("long"))
    return n.withColumns({c: F.expr(e) for c, e in changes.items()}).drop("n")


def _changed_sql(name: str, changes: dict[str, str]) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in changes.items())
    return f"""{CUR}, numbered AS (SELECT *, CAST(substr(event_uuid, 3) AS BIGINT) AS n FROM cur),
    {name} AS (SELECT * EXCLUDE (n) REPLACE ({columns}) FROM numbered)"""


DAMAGED = {
    "game_id": "CASE WHEN n % 97 = 0 THEN NULL ELSE game_id END",
    "session_id": "CASE WHEN n % 101 = 0 THEN NULL ELSE session_id END",
    "category": "CASE WHEN n % 89 = 0 THEN 'bogus' WHEN n % 83 = 0 THEN NULL ELSE category END",
    "event_uuid": "CASE WHEN n % 79 = 0 THEN 'e-again' WHEN n % 103 = 0 THEN NULL ELSE event_uuid END",
}
VARIED = {
    "platform": "CASE WHEN n % 5 = 0 THEN NULL ELSE platform END",
    "build": "CASE WHEN n % 3 = 0 THEN '1.1' ELSE build END",
    "event_id": "CASE WHEN n % 7 < 3 THEN concat('place_', CAST(n % 4 AS VARCHAR(20))) ELSE event_id END",
    "category": "CASE n % 7 WHEN 0 THEN 'ad' WHEN 1 THEN 'impression' WHEN 2 THEN 'design' ELSE category END",
    "progression_status": "CASE WHEN n % 13 = 0 THEN 'bogus' WHEN n % 17 = 0 THEN 'START' ELSE progression_status END",
}
VARIED_SQL = _changed_sql("varied", VARIED)


def _varied(spark, sf_dir):
    return _changed(_cur(spark, sf_dir), VARIED)


@register("quality_gate_damaged", f"{_changed_sql('damaged', DAMAGED)} {O.gate_body('damaged')}")
def q_quality_gate_damaged(spark, sf_dir):
    """The gate over rows with missing fields, repeated and null ids and unknown categories."""
    return quality_gate_by_date(_changed(_cur(spark, sf_dir), DAMAGED))


@register(
    "progression_status",
    f"""{VARIED_SQL} SELECT event_uuid, progression_status,
      coalesce(lower(progression_status) IN ('start', 'fail', 'complete'), false) AS is_valid FROM varied""",
)
def q_progression_status(spark, sf_dir):
    return _varied(spark, sf_dir).select(
        "event_uuid", "progression_status", is_valid_progression_status("progression_status").alias("is_valid")
    )


@register(
    "placement_exposure_varied",
    f"""{VARIED_SQL} SELECT * FROM (SELECT {O.DIMS}, category, event_id, count(*) AS events,
        count(DISTINCT player_key) AS players FROM varied
      WHERE category IN ('ad', 'impression', 'design') GROUP BY ALL) WHERE players >= {MIN_FUNNEL}""",
)
def q_placement_exposure_varied(spark, sf_dir):
    return build_placement_exposure(_varied(spark, sf_dir), MIN_FUNNEL)


@register(
    "release_view_varied",
    f"""{VARIED_SQL}, s AS ({O.sessions_body().replace("FROM cur", "FROM varied")})
    SELECT * FROM (SELECT game_id, event_date, build, count(DISTINCT player_key) AS dau,
        count(DISTINCT session_id) AS sessions, avg(session_seconds) AS avg_session_seconds,
        CAST(1.0 AS DOUBLE) - avg(CAST(has_error AS DOUBLE)) AS crash_free_session_rate
      FROM s GROUP BY game_id, event_date, build) WHERE dau >= {MIN_EXTRA}""",
)
def q_release_view_varied(spark, sf_dir):
    return build_release_view(build_sessions(_varied(spark, sf_dir)), MIN_EXTRA)


@register(
    "daily_engagement_null_dimensions",
    f"""{VARIED_SQL}, s AS ({O.sessions_body().replace("FROM cur", "FROM varied")})
    {O.engagement_body(MIN_FUNNEL).replace("FROM cur", "FROM varied")}""",
)
def q_daily_engagement_null_dimensions(spark, sf_dir):
    return build_daily_engagement(session_facts(_varied(spark, sf_dir)), minimum_group_size=MIN_FUNNEL)


@register(
    "player_activity_days_varied",
    f"""{VARIED_SQL} SELECT game_id, player_key, event_date, signup_date, platform, build, country_code,
        CAST(event_date - signup_date AS INTEGER) AS day_number
      FROM (SELECT *, row_number() OVER (PARTITION BY game_id, player_key, event_date
                ORDER BY event_time, signup_date NULLS FIRST, platform NULLS FIRST,
                         build NULLS FIRST, country_code NULLS FIRST) AS rn
            FROM varied WHERE signup_date IS NOT NULL) WHERE rn = 1""",
)
def q_player_activity_days_varied(spark, sf_dir):
    """Players with several builds and a missing platform on one day."""
    return player_activity_days(_varied(spark, sf_dir))


@register(
    "file_profile_bad_lines",
    f"""{VALID} SELECT p.* REPLACE (events + k AS events, invalid_events + k AS invalid_events)
    FROM ({O.file_profile_body()}) p,
      (SELECT 3 * count(*) AS k FROM env WHERE CAST(substr(event_uuid, 3) AS BIGINT) % 50 = 0)""",
)
def q_file_profile_bad_lines(spark, sf_dir):
    """The export with malformed lines, lines without fields and lines of an unknown category."""
    path = scratch_path(spark, "export-bad")
    env = events_to_envelope(read_table(spark, sf_dir, "events"))
    some = env.filter(F.substring("event_uuid", 3, 18).cast("long") % 50 == 0)
    bad = [
        some.select(F.concat(F.lit('{"event_uuid": "'), "event_uuid").alias("value")),
        some.select(F.concat(F.lit('{"event_uuid": "'), "event_uuid", F.lit('"}')).alias("value")),
        envelope_to_json(some.withColumn("category", F.lit("bogus"))),
    ]
    write_json_lines(reduce(DataFrame.unionByName, [envelope_to_json(env), *bad]), path, "gzip")
    return P.file_profile(P.parse_lines(read_json_lines(spark, path)))


LATE_FROM = "2024-01-20"


def _stream_of_parts(spark, sf_dir):
    """Days in order, then days that the watermark has long passed, one run of the stream each.

    A micro-batch drops what is behind the watermark of the batch before the last, so two
    parts come first. Returns where the rows and the batches' metrics are."""
    landing, out, ck, metrics = (scratch_path(spark, x) for x in ("landing", "ingest-out", "ingest-ck", "ingest-metrics"))
    env = events_to_envelope(read_table(spark, sf_dir, "events"))
    day = F.to_date("event_time")
    for part in (day.between(LATE_FROM, "2024-01-25"), day > "2024-01-25", day < LATE_FROM):
        write_json_lines(envelope_to_json(env.filter(part)), landing, mode="append")
        curated = ingest(read_json_stream(spark, landing, max_files_per_trigger=None), FIXTURE_SALT)
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            query = ingest_writer(curated, ck, available_now=True).start(out)
        recorded(spark, query, metrics)
    return out, metrics


@register("ingest_stream_late", f"{CUR} SELECT * FROM cur WHERE event_date >= DATE '{LATE_FROM}'")
def q_ingest_stream_late(spark, sf_dir):
    """Rows behind the watermark are dropped, all others land."""
    return spark.read.parquet(_stream_of_parts(spark, sf_dir)[0]).select(*NO_INGEST_TIME)


@register(
    "ingest_dropped_rows",
    f"""{CUR} SELECT CASE WHEN event_date < DATE '{LATE_FROM}' THEN 3 WHEN event_date <= DATE '2024-01-25' THEN 1 ELSE 2 END AS batch,
      count(*) AS input_rows, count(*) FILTER (WHERE event_date < DATE '{LATE_FROM}') AS dropped_rows FROM cur GROUP BY 1""",
)
def q_ingest_dropped_rows(spark, sf_dir):
    """What each micro-batch took in and dropped, from the table that the ingest keeps of it."""
    rows = spark.read.parquet(_stream_of_parts(spark, sf_dir)[1])
    number = F.row_number().over(Window.partitionBy("query_id").orderBy("batch_id"))  # a row a batch
    return rows.select(number.alias("batch"), "input_rows", "dropped_rows")


@register("ingest_stream_table", CURATED_SQL)
def q_ingest_stream_table(spark, sf_dir):
    """The stream into a catalog table, stopped and started again between two deliveries, of which
    the second sends the first again: every row once. The watermark delay exceeds the data's span."""
    landing = scratch_path(spark, "landing")
    config = JobConfig(
        warehouse=scratch_path(spark, "warehouse"), player_salt=FIXTURE_SALT, checkpoint_location=scratch_path(spark, "ingest-ck"),
        state_partitions=spark.sparkContext.defaultParallelism, watermark="45 days", lookback_days=45, **_named(),
    )
    lines = load_json_lines(spark, sf_dir)
    for part in (lines.filter(F.hash("value") % 2 == 0), lines):
        write_json_lines(part, landing, mode="append")
        start_ingest(read_json_stream(spark, landing), config, available_now=True).awaitTermination()
    return spark.table(str(config.table_at(config.raw_table))).select(*NO_INGEST_TIME)


# ---- X2-X4 ----------------------------------------------------------------------------
@register(
    "monetization",
    f"""{CUR}, s AS (
      SELECT game_id, player_key, session_id, event_date, platform, build, country_code,
        sum(CASE WHEN category = 'business' THEN coalesce(amount, 0) END) AS revenue_cents
      FROM cur GROUP BY ALL)
    SELECT *, {O.rate('revenue_usd', 'dau')} AS revenue_per_active_player,
      {O.rate('revenue_usd', 'paying_players')} AS revenue_per_paying_player
    FROM (SELECT {O.DIMS}, count(DISTINCT player_key) AS dau,
            count(DISTINCT CASE WHEN revenue_cents IS NOT NULL THEN player_key END) AS paying_players,
            CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS revenue_usd
          FROM s GROUP BY {O.DIMS})
    WHERE dau >= {MIN_EXTRA}""",
)
def q_monetization(spark, sf_dir):
    return build_monetization(session_facts(_cur(spark, sf_dir)), MIN_EXTRA)


@register(
    "release_view",
    f"""{CUR}, s AS ({O.sessions_body()})
    SELECT * FROM (SELECT game_id, event_date, build, count(DISTINCT player_key) AS dau,
        count(DISTINCT session_id) AS sessions, avg(session_seconds) AS avg_session_seconds,
        CAST(1.0 AS DOUBLE) - avg(CAST(has_error AS DOUBLE)) AS crash_free_session_rate
      FROM s GROUP BY game_id, event_date, build) WHERE dau >= {MIN_EXTRA}""",
)
def q_release_view(spark, sf_dir):
    return build_release_view(build_sessions(_cur(spark, sf_dir)), MIN_EXTRA)


def _bitmaps(spark, sf_dir):
    """Bitmaps and sums per day and dimensions, stored; ids of late players are added to those of the first days."""
    sessions = build_sessions(_varied(spark, sf_dir))
    early = sessions.filter(F.col("event_date") < F.lit(LATE_FROM).cast("date"))
    ids = {c: dense_ids(sessions, c, known=staged(dense_ids(early, c), f"ids-{c}")) for c in ("player_key", "session_id")}
    by = ["game_id", "event_date", *BREAKDOWN_DIMENSIONS]
    return staged(distinct_bitmaps(sessions, by, ids), "bitmaps"), staged(session_sums(sessions, by), "sums")


@register("release_view_of_bitmaps", SQL["release_view_varied"])
def q_release_view_of_bitmaps(spark, sf_dir):
    """The release view from stored bitmaps: equal to the recount of the sessions."""
    return bitmap_release_view(*_bitmaps(spark, sf_dir), MIN_EXTRA)


@register(
    "monthly_players_of_bitmaps",
    f"""{VARIED_SQL}, s AS ({O.sessions_body().replace("FROM cur", "FROM varied")})
    SELECT game_id, strftime(event_date, '%Y-%m') AS month, platform, count(DISTINCT player_key) AS players,
      count(DISTINCT session_id) AS sessions FROM s GROUP BY ALL""",
)
def q_monthly_players_of_bitmaps(spark, sf_dir):
    """Distinct players and sessions per month and platform, OR-ed from the days' bitmaps."""
    by = ["game_id", F.date_format("event_date", "yyyy-MM").alias("month"), "platform"]
    counts = distinct_counts(_bitmaps(spark, sf_dir)[0], by, ["player_key", "session_id"])
    return counts.withColumnsRenamed({"player_key": "players", "session_id": "sessions"})


@register("profile_distincts_of_bitmaps", f"{VALID} SELECT count(DISTINCT user_id) AS players, count(DISTINCT session_id) AS sessions FROM v")
def q_profile_distincts_of_bitmaps(spark, sf_dir):
    """Players and sessions of the file profile from one bitmap per day."""
    rows = staged(P.valid_rows(_parsed(spark, sf_dir)).select("event_day", "user_id", "session_id"), "valid")
    days = staged(distinct_bitmaps(rows, ["event_day"], {c: dense_ids(rows, c) for c in ("user_id", "session_id")}), "bitmaps")
    return distinct_counts(days, [], ["user_id", "session_id"]).withColumnsRenamed({"user_id": "players", "session_id": "sessions"})


@register(
    "placement_exposure",
    f"""{CUR} SELECT * FROM (SELECT {O.DIMS}, category, event_id, count(*) AS events,
        count(DISTINCT player_key) AS players FROM cur
      WHERE category IN ('ad', 'impression', 'design') GROUP BY ALL) WHERE players >= {MIN_EXTRA}""",
)
def q_placement_exposure(spark, sf_dir):
    return build_placement_exposure(_cur(spark, sf_dir), MIN_EXTRA)


# ---- A4 activity days -----------------------------------------------------------------
@register(
    "player_activity_days",
    f"""{CUR} SELECT game_id, player_key, event_date, signup_date, platform, build, country_code,
        CAST(event_date - signup_date AS INTEGER) AS day_number
      FROM (SELECT *, row_number() OVER (PARTITION BY game_id, player_key, event_date
                ORDER BY event_time, signup_date NULLS FIRST, platform NULLS FIRST,
                         build NULLS FIRST, country_code NULLS FIRST) AS rn
            FROM cur WHERE signup_date IS NOT NULL) WHERE rn = 1""",
)
def q_player_activity_days(spark, sf_dir):
    return player_activity_days(_cur(spark, sf_dir))
