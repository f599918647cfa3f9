"""DuckDB statements that compute each registered query independently of Spark.

They follow the definitions of the metrics (for example: distinct counts, a join
between engagement and revenue), not the Spark plans, so they check the plans.
``curated_cte(salt)`` is the generic ``events`` table mapped onto the curated event
table, written a second time from the mapping in ``playpulse/sources/fixtures.py``.
"""

from __future__ import annotations

DIMS = "game_id, event_date, platform, build, country_code"


CATEGORY_CASE = """CASE lower(trim(event_type)) WHEN 'signup' THEN 'user' WHEN 'purchase' THEN 'business'
        WHEN 'error' THEN 'error' WHEN 'click' THEN 'progression'
        WHEN 'view' THEN 'resource' ELSE lower(trim(event_type)) END AS category"""


def envelope_sql() -> str:
    return f"""
    SELECT
      'e-' || event_id AS event_uuid,
      ts AS event_time,
      'game-' || CAST(user_id % 5 = 4 AS INTEGER) AS game_id,
      'player-' || user_id AS user_id,
      'player-' || user_id || '-'
        || CAST(floor((epoch_us(ts) + 10800000000) / 21600000000) AS BIGINT) AS session_id,
      {CATEGORY_CASE},
      CAST(NULL AS VARCHAR) AS event_id,
      CASE WHEN event_type = 'click' THEN
        CASE event_id % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'complete' ELSE 'fail' END
      END AS progression_status,
      CASE WHEN event_type = 'click' THEN
        'level_' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 8)
      END AS progression_01,
      CAST(NULL AS VARCHAR) AS progression_02,
      CAST(NULL AS VARCHAR) AS progression_03,
      CASE WHEN event_type = 'purchase' THEN 'USD' END AS currency,
      CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT)
           WHEN event_type = 'view' THEN CAST(round(value) AS BIGINT) END AS amount,
      CASE WHEN event_type = 'view' THEN 'item_' || (event_id % 2) END AS item_type,
      CAST(NULL AS VARCHAR) AS item_id,
      CASE WHEN event_type = 'view' THEN
        CASE WHEN event_id % 2 = 0 THEN 'source' ELSE 'sink' END END AS flow_type,
      CASE WHEN event_type = 'view' THEN 'credits' END AS virtual_currency,
      CAST(NULL AS VARCHAR) AS severity,
      CAST(NULL AS VARCHAR) AS message,
      CAST(NULL AS DOUBLE) AS value,
      CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS platform,
      CAST(NULL AS VARCHAR) AS os_version,
      '1.0' AS build,
      CASE WHEN user_id % 5 = 0 THEN 'CA' ELSE 'US' END AS country_code,
      CAST(DATE '2023-12-30' + CAST(user_id % 3 AS INTEGER) AS DATE) AS signup_date
    FROM events
    """


def curated_cte(salt: str) -> str:
    """``WITH env AS (..), cur AS (..)``: envelope and curated rows (no ingested_at)."""
    return f"""
    WITH env AS ({envelope_sql()}),
    cur AS (
      SELECT event_uuid, event_time, game_id, session_id, category, event_id,
        progression_status, progression_01, progression_02, progression_03, currency,
        amount, item_type, item_id, flow_type, virtual_currency, severity, message, value,
        platform, os_version, build, country_code, signup_date,
        CAST(event_time AS DATE) AS event_date,
        sha256('{salt}' || coalesce(user_id, 'missing')) AS player_key
      FROM env
    )"""


def sessions_body() -> str:
    return f"""
      SELECT game_id, player_key, session_id, event_date, platform, build, country_code,
        min(event_time) AS session_started_at,
        max(event_time) AS session_ended_at,
        count(*) AS event_count,
        max(CASE WHEN category = 'error' THEN 1 ELSE 0 END) AS has_error,
        greatest(0, epoch_us(max(event_time)) // 1000000
                    - epoch_us(min(event_time)) // 1000000) AS session_seconds
      FROM cur
      GROUP BY game_id, player_key, session_id, event_date, platform, build, country_code"""


def revenue_body() -> str:
    return f"""
      SELECT {DIMS}, CAST(sum(coalesce(amount, 0)) AS DOUBLE) / 100.0 AS revenue_usd
      FROM cur WHERE category = 'business' GROUP BY {DIMS}"""


def engagement_body(min_group: int, null_safe: bool = True) -> str:
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    join = " AND ".join(f"e.{c} {eq} r.{c}" for c in DIMS.split(", "))
    return f"""
      SELECT e.*, coalesce(r.revenue_usd, 0.0) AS revenue_usd
      FROM (
        SELECT {DIMS},
          count(DISTINCT player_key) AS dau,
          count(DISTINCT session_id) AS sessions,
          avg(session_seconds) AS avg_session_seconds,
          quantile_disc(session_seconds, 0.95) AS p95_session_seconds,
          CAST(1.0 AS DOUBLE) - avg(CAST(has_error AS DOUBLE)) AS crash_free_session_rate
        FROM s GROUP BY {DIMS}
      ) e
      LEFT JOIN ({revenue_body()}) r ON {join}
      WHERE e.dau >= {min_group}"""


def rate(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / {d} ELSE 0.0 END"


def retention_flags_body() -> str:
    return """
      SELECT game_id, player_key, signup_date, platform, build, country_code,
        max(CASE WHEN event_date - signup_date = 1 THEN 1 ELSE 0 END) AS retained_d1,
        max(CASE WHEN event_date - signup_date = 7 THEN 1 ELSE 0 END) AS retained_d7,
        max(CASE WHEN event_date - signup_date = 30 THEN 1 ELSE 0 END) AS retained_d30
      FROM (
        SELECT *, row_number() OVER (
          PARTITION BY game_id, player_key, event_date
          ORDER BY event_time, signup_date NULLS FIRST, platform NULLS FIRST,
                   build NULLS FIRST, country_code NULLS FIRST) AS rn
        FROM cur WHERE signup_date IS NOT NULL
      ) WHERE rn = 1
      GROUP BY game_id, player_key, signup_date, platform, build, country_code"""


def retention_body(min_group: int) -> str:
    return f"""
      SELECT game_id, cohort_date, platform, build, country_code, cohort_size,
        retained_d1_players, retained_d7_players, retained_d30_players,
        {rate('retained_d1_players', 'cohort_size')} AS d1_retention,
        {rate('retained_d7_players', 'cohort_size')} AS d7_retention,
        {rate('retained_d30_players', 'cohort_size')} AS d30_retention
      FROM (
        SELECT game_id, signup_date AS cohort_date, platform, build, country_code,
          count(DISTINCT player_key) AS cohort_size,
          CAST(sum(retained_d1) AS BIGINT) AS retained_d1_players,
          CAST(sum(retained_d7) AS BIGINT) AS retained_d7_players,
          CAST(sum(retained_d30) AS BIGINT) AS retained_d30_players
        FROM ({retention_flags_body()})
        GROUP BY game_id, signup_date, platform, build, country_code
      ) WHERE cohort_size >= {min_group}"""


def funnel_body(min_group: int) -> str:
    return f"""
      SELECT *, {rate('players_completed', 'players_started')} AS completion_rate
      FROM (
        SELECT {DIMS}, progression_01 AS level,
          count(DISTINCT CASE WHEN progression_status = 'start' THEN player_key END) AS players_started,
          count(DISTINCT CASE WHEN progression_status = 'fail' THEN player_key END) AS players_failed,
          count(DISTINCT CASE WHEN progression_status = 'complete' THEN player_key END) AS players_completed
        FROM cur WHERE category = 'progression' AND progression_01 IS NOT NULL
        GROUP BY {DIMS}, progression_01
      ) WHERE players_started >= {min_group}"""


def economy_body(min_group: int) -> str:
    return f"""
      SELECT *, currency_source - currency_sink AS net_currency_flow
      FROM (
        SELECT {DIMS}, virtual_currency, item_type,
          count(DISTINCT player_key) AS supporting_players,
          CAST(sum(CASE WHEN flow_type = 'source' THEN coalesce(amount, 0) ELSE 0 END) AS BIGINT) AS currency_source,
          CAST(sum(CASE WHEN flow_type = 'sink' THEN coalesce(amount, 0) ELSE 0 END) AS BIGINT) AS currency_sink
        FROM cur WHERE category = 'resource'
        GROUP BY {DIMS}, virtual_currency, item_type
      ) WHERE supporting_players >= {min_group}"""


SUPPORTED_SQL = (
    "('user', 'session_end', 'business', 'progression', 'resource', 'design', 'error', "
    "'ad', 'impression')"
)


def pct(n: str, d: str) -> str:
    """Percent to two decimals, ties away from zero; 0.0 when ``d`` is 0."""
    return f"CASE WHEN ({d}) = 0 THEN 0.0 ELSE round(100.0::DOUBLE * ({n}) / ({d}), 2) END"


def gate_body(source: str = "cur", run_date: str | None = None) -> str:
    """The four checks per event date, or for one ``run_date`` (then without a date
    column, and an empty day still yields its four rows)."""
    missing = " OR ".join(
        f"{c} IS NULL"
        for c in ("event_uuid", "game_id", "player_key", "session_id", "event_time", "category")
    )
    if run_date is None:
        key, where, day = "event_date, ", "", "CAST(event_date AS VARCHAR)"
    else:
        key, where, day = "", f"WHERE event_date = DATE '{run_date}'", f"'{run_date}'"
    checks = [
        ("row_count", "row_count > 0", f"'No events found for ' || {day}"),
        ("missing_required", "missing_required = 0",
         "CAST(missing_required AS VARCHAR) || ' rows have missing required fields'"),
        ("duplicate_event_ids", "duplicate_event_ids = 0",
         "CAST(duplicate_event_ids AS VARCHAR) || ' duplicate event identifiers were found'"),
        ("unsupported_categories", "unsupported_categories = 0",
         "CAST(unsupported_categories AS VARCHAR) || ' unsupported categories were found'"),
    ]
    union = "\n      UNION ALL ".join(
        f"SELECT {key}{i} AS check_order, '{name}' AS check_name, {name} AS observed, "
        f"{ok} AS passed, CASE WHEN NOT ({ok}) THEN {msg} END AS message FROM t"
        for i, (name, ok, msg) in enumerate(checks)
    )
    rows = f"(SELECT * FROM {source} {where})"
    if run_date is None:
        repeated = f"(SELECT count(*) FROM (SELECT event_uuid FROM {rows} r WHERE r.event_date = days.event_date GROUP BY event_uuid HAVING count(*) > 1))"
        counted = f"(SELECT event_date, {{}} FROM {rows} GROUP BY event_date) AS days"
    else:
        repeated = f"(SELECT count(*) FROM (SELECT event_uuid FROM {rows} GROUP BY event_uuid HAVING count(*) > 1))"
        counted = f"(SELECT {{}} FROM {rows})"
    counts = f"""count(*) AS row_count, count(*) FILTER (WHERE {missing}) AS missing_required,
        count(*) FILTER (WHERE category NOT IN {SUPPORTED_SQL}) AS unsupported_categories"""
    return f""",
    t AS (SELECT *, {repeated} AS duplicate_event_ids FROM {counted.format(counts)})
      {union}"""


def valid_cte() -> str:
    """``env`` plus ``v``: the valid rows of the JSON-lines export of the envelope."""
    return f"""
    WITH env AS ({envelope_sql()}),
    v AS (
      SELECT *, CAST(event_time AS DATE) AS event_day FROM env
      WHERE category IN {SUPPORTED_SQL} AND event_uuid <> '' AND user_id <> ''
        AND session_id <> '' AND event_time IS NOT NULL AND signup_date IS NOT NULL
    )"""


def file_profile_body() -> str:
    return """
      SELECT (SELECT count(*) FROM env) AS events,
        count(*) AS valid_events,
        (SELECT count(*) FROM env) - count(*) AS invalid_events,
        count(*) - count(DISTINCT event_uuid) AS duplicate_event_ids,
        count(DISTINCT user_id) AS players,
        count(DISTINCT session_id) AS sessions
      FROM v"""


def eligible_retention_body() -> str:
    sel = []
    for n in (1, 7, 30):
        sel.append(f"count(*) FILTER (WHERE last_day - cohort_day >= {n}) AS eligible_d{n}")
        sel.append(
            f"count(*) FILTER (WHERE last_day - cohort_day >= {n} AND a{n} = 1) AS retained_d{n}"
        )
    pcts = ", ".join(f"{pct(f'retained_d{n}', f'eligible_d{n}')} AS d{n}_retention_percent" for n in (1, 7, 30))
    return f""",
    pd AS (SELECT user_id, event_day, min(signup_date) AS signup FROM v GROUP BY user_id, event_day),
    pl AS (SELECT user_id, min(signup) AS cohort_day FROM pd GROUP BY user_id),
    fl AS (
      SELECT pl.user_id, pl.cohort_day,
        max(CASE WHEN pd.event_day - pl.cohort_day = 1 THEN 1 ELSE 0 END) AS a1,
        max(CASE WHEN pd.event_day - pl.cohort_day = 7 THEN 1 ELSE 0 END) AS a7,
        max(CASE WHEN pd.event_day - pl.cohort_day = 30 THEN 1 ELSE 0 END) AS a30
      FROM pl JOIN pd ON pl.user_id = pd.user_id GROUP BY pl.user_id, pl.cohort_day),
    agg AS (
      SELECT {', '.join(sel)}
      FROM fl, (SELECT max(event_day) AS last_day FROM pd) m)
    SELECT *, {pcts} FROM agg"""


def level_counts_body() -> str:
    return """
      SELECT coalesce(nullif(progression_01, ''), 'unknown') AS level,
        count(*) FILTER (WHERE progression_status = 'start') AS starts,
        count(*) FILTER (WHERE progression_status = 'complete') AS completions
      FROM v WHERE category = 'progression' GROUP BY 1"""


def hardest_levels_body(min_starts: int) -> str:
    return f"""
      SELECT level, starts, completions, {pct('completions', 'starts')} AS completion_rate
      FROM ({level_counts_body()}) WHERE starts >= {max(min_starts, 1)}
      ORDER BY completion_rate, level LIMIT 5"""


def sample_keys_body(salt: str) -> str:
    return f"""
      SELECT CAST(row_number() OVER (ORDER BY event_time, event_uuid) AS INTEGER) AS sample_rank,
        sha256('{salt}' || user_id) AS player_key
      FROM v ORDER BY event_time, event_uuid LIMIT 5"""


def privacy_groups_body(threshold: int) -> str:
    return f"""
      SELECT count(*) AS privacy_groups,
        count(*) FILTER (WHERE n < {threshold}) AS privacy_groups_suppressed,
        {threshold} AS privacy_threshold
      FROM (SELECT coalesce(country_code, 'unknown'), event_day, count(*) AS n
            FROM v GROUP BY 1, 2)"""


def summary_body(salt: str, threshold: int) -> str:
    ret = eligible_retention_body().split("SELECT *,", 1)
    return f"""{ret[0]},
    ret AS (SELECT {ret[1].replace(' FROM agg', '')} FROM agg),
    cats AS (SELECT category, count(*) AS events FROM v GROUP BY category),
    hard AS ({hardest_levels_body(threshold)}),
    keys AS ({sample_keys_body(salt)}),
    prof AS ({file_profile_body()}),
    err AS (SELECT count(DISTINCT CASE WHEN category = 'error' THEN session_id END) AS e,
                   count(DISTINCT session_id) AS s FROM v),
    rev AS (SELECT CAST(sum(CASE WHEN category = 'business' THEN coalesce(amount, 0) ELSE 0 END) AS BIGINT) AS c FROM v),
    priv AS ({privacy_groups_body(threshold)})
    SELECT prof.*,
      (SELECT map_from_entries(list(struct_pack(k := category, v := events) ORDER BY category)) FROM cats) AS category_counts,
      ret.d1_retention_percent, ret.d7_retention_percent, ret.d30_retention_percent,
      {pct('err.e', 'err.s')} AS error_session_rate_percent,
      round(CAST(coalesce(rev.c, 0) AS DOUBLE) / 100.0, 2) AS revenue_usd,
      priv.privacy_groups_suppressed, priv.privacy_threshold,
      coalesce((SELECT list(struct_pack(level := level, starts := starts, completions := completions,
                               completion_rate := completion_rate) ORDER BY completion_rate, level)
       FROM hard), []) AS hardest_levels,
      (SELECT list(player_key ORDER BY sample_rank) FROM keys) AS sample_hashed_player_keys
    FROM prof, ret, err, rev, priv"""
