"""DuckDB SQL giving the expected result of each query over the same tables."""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
# Whole seconds since 1970.
_SECOND = "(epoch_us({0}) // 1000000)"
_DAY_MS = "CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT)"


def _sessions(user: str, ts: str, rows: str, gap_seconds: int, user_name: str,
              more: str = "") -> str:
    gap = f"{_SECOND.format(ts)} - lag({_SECOND.format(ts)}) OVER w"
    return f"""
        WITH gaps AS (
            SELECT {user} AS u, {ts} AS t, {gap} AS idle
            FROM {rows} WINDOW w AS (PARTITION BY {user} ORDER BY {ts})),
        starts AS (SELECT * FROM gaps WHERE idle IS NULL OR idle > {gap_seconds})
        SELECT concat(u, '-', row_number() OVER (PARTITION BY u ORDER BY t)) AS session_id,
               u AS {user_name}, t AS session_start_at,
               lead(t) OVER (PARTITION BY u ORDER BY t) AS next_session_start_at{more}
        FROM starts"""


def _week(day: str) -> str:
    """The Sunday before the Monday of the week of ``day``."""
    return f"CAST(date_trunc('week', {day}) AS DATE) - 1"


_SESSIONS_ALL_EVENTS = f"""
    WITH gaps AS (
        SELECT *, {_SECOND.format('ts')} - lag({_SECOND.format('ts')}) OVER w AS idle
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    marked AS (SELECT *, idle IS NULL OR idle > 21600 AS is_start FROM gaps),
    numbered AS (
        SELECT *, CAST(count(*) FILTER (WHERE is_start) OVER w AS BIGINT) AS session_number
        FROM marked WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT event_id, user_id, ts, event_type, session_number,
           min(ts) OVER (PARTITION BY user_id, session_number) AS session_start_at,
           concat(user_id, '-', session_number) AS session_id
    FROM numbered"""

_LOCAL = "ts + INTERVAL 9 HOUR"
_NEXT_DAY = f"CAST(CAST({_LOCAL} AS DATE) + 1 AS DATE)"

_CALENDAR_KEYS = f"""
    SELECT event_id, ts, {_LOCAL} AS local_timestamp, {_NEXT_DAY} AS next_local_day,
           {_week(_NEXT_DAY)} AS ywd,
           concat(year({_NEXT_DAY}), '-', week({_NEXT_DAY})) AS yw,
           strftime(ts, '%Y-%m') AS ym, strftime(ts, '%Y-%m-%d') AS ymd
    FROM events"""

_CALENDAR_KEYS_ISO_LOCAL = f"""
    SELECT event_id, ts, {_LOCAL} AS local_timestamp, {_NEXT_DAY} AS next_local_day,
           CAST({_LOCAL} AS DATE) - 1 AS ywd,
           concat(isoyear({_NEXT_DAY}), '-', lpad(CAST(week({_NEXT_DAY}) AS VARCHAR), 2, '0')) AS yw,
           strftime({_LOCAL}, '%Y-%m') AS ym, strftime({_LOCAL}, '%Y-%m-%d') AS ymd
    FROM events"""

_CALENDAR_KEYS_ORDERS = f"""
    WITH days AS (SELECT *, o_orderdate + INTERVAL 9 HOUR AS local_timestamp FROM orders),
    d AS (SELECT *, CAST(CAST(local_timestamp AS DATE) + 1 AS DATE) AS next_local_day FROM days)
    SELECT o_orderkey, o_orderdate, local_timestamp, next_local_day,
           {_week('next_local_day')} AS ywd,
           concat(year(next_local_day), '-', week(next_local_day)) AS yw_plain,
           concat(isoyear(next_local_day), '-',
                  lpad(CAST(week(next_local_day) AS VARCHAR), 2, '0')) AS yw,
           strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y-%m-%d') AS ymd
    FROM d"""


def _hospital(prefix: str, position: int) -> str:
    if position == 0:
        return f"CASE WHEN k % 3 IN (0, 1) THEN CAST(k AS VARCHAR) END"
    return f"CASE WHEN k % 3 = 0 THEN concat('{prefix}', k) END"


def _hospital_list(prefix: str) -> str:
    """Both elements joined by a comma; empty where there is no array."""
    return (f"CASE WHEN k % 3 = 0 THEN concat(k, ',{prefix}', k) "
            f"WHEN k % 3 = 1 THEN CAST(k AS VARCHAR) ELSE '' END")


_WITH_K = f"WITH e AS (SELECT *, {_K} AS k FROM events)"
_USER = "CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END"
_LOCALE = "CASE WHEN user_id % 2 = 0 THEN 'ko-KR' ELSE 'en-US' END"

_FLATTEN_EVENTS = f"""
    {_WITH_K}
    SELECT CAST(user_id AS VARCHAR) AS "anonymousId",
           concat('agent/', user_id % 5) AS context_useragent,
           concat('10.0.0.', user_id % 256) AS context_ip,
           {_LOCALE} AS context_locale,
           concat('/', event_type) AS context_page_url,
           concat('m-', event_id) AS "messageId",
           concat('/p/', event_type) AS properties_path,
           event_type AS properties_page,
           concat('b-', event_type) AS properties_button_name,
           concat('a-', event_type) AS properties_action_name,
           {_hospital('A', 0)} AS properties_action_hospital_id,
           {_hospital('A', 1)} AS properties_action_hospital_name,
           {_hospital('B', 0)} AS properties_button_hospital_num,
           {_hospital('B', 1)} AS properties_button_hospital_name,
           CAST(k AS VARCHAR) AS properties_properties_hospitalid,
           event_type AS properties_properties_pagename,
           CAST(NULL AS VARCHAR) AS properties_properties_routename,
           concat('to-', k) AS properties_properties_to,
           event_type AS event,
           {_LOCAL} AS "timestamp",
           concat(year({_NEXT_DAY}), '-', week({_NEXT_DAY})) AS yw,
           {_week(_NEXT_DAY)} AS ywd,
           strftime(ts, '%Y-%m') AS ym, strftime(ts, '%Y-%m-%d') AS ymd,
           'track' AS type, {_USER} AS "userId"
    FROM e"""

_SAFE_COLUMNS = f"""
    {_WITH_K}
    SELECT concat('m-', event_id) AS "messageId", concat('/', event_type) AS page_url,
           CAST(NULL AS VARCHAR) AS page_title, {_hospital('A', 1)} AS hospital_name,
           CAST(NULL AS BIGINT) AS hospital_rank, CAST(NULL AS VARCHAR) AS absent_struct,
           concat('agent/', user_id % 5) AS any_case,
           CAST(k AS BIGINT) AS number, TRY_CAST(event_type AS BIGINT) AS word
    FROM e"""

_AUTO_FLATTEN = f"""
    {_WITH_K}
    SELECT CAST(user_id AS VARCHAR) AS "anonymousId",
           concat('agent/', user_id % 5) AS "context_userAgent",
           concat('10.0.0.', user_id % 256) AS context_ip, {_LOCALE} AS context_locale,
           concat('/', event_type) AS context_page_url,
           concat('m-', event_id) AS "messageId",
           concat('/p/', event_type) AS properties_path, event_type AS properties_page,
           concat('b-', event_type) AS properties_button_name,
           {_hospital_list('B')} AS properties_button_hospital,
           concat('a-', event_type) AS properties_action_name,
           {_hospital_list('A')} AS properties_action_hospital,
           CAST(k AS VARCHAR) AS "properties_properties_hospitalId",
           event_type AS "properties_properties_pageName",
           CAST(NULL AS VARCHAR) AS "properties_properties_routeName",
           concat('to-', k) AS properties_properties_to,
           event_type AS event, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
           'track' AS type, {_USER} AS "userId"
    FROM e"""

_LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _top_line(description: str, column: str, unit: str, sentinel: float) -> str:
    by = ", ".join(f"{c} DESC" for c in ("v", *_LINE_KEYS.split(", ")))
    return f"""(SELECT '{description}' AS description, '{column}' AS column_name, {_LINE_KEYS},
                       v AS value, '{unit}' AS units
                FROM (SELECT *, {column} AS v FROM lines) WHERE v <> {sentinel}
                ORDER BY {by} LIMIT 1)"""


_EXTREMES_OF_LINES = """
    WITH lines AS (SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem)
    """ + " UNION ALL ".join([
    _top_line("Largest quantity", "l_quantity", "units", 50),
    _top_line("Largest price", "l_extendedprice", "USD", 50),
    _top_line("Largest discount", "l_discount", "share", 50),
    _top_line("Largest tax", "l_tax", "share", 0.08),
    _top_line("Largest net price", "net_price", "USD", 50),
])


def _metrics(pairs: list[tuple[str, str]], rows: str, line: bool = False) -> str:
    """``(metric, value)`` rows from expressions over one table."""
    text = ", concat('{0}: ', {1}) AS line" if line else ""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({value} AS BIGINT) AS value"
        f"{text.format(name, value)} FROM {rows}" for name, value in pairs)


def _six(prefixes: tuple[str, str], key: str) -> list[tuple[str, str]]:
    return [pair for p in prefixes for pair in (
        (f"{p}_pk_count", "count(*)"),
        (f"distinct_{p}_pk_count", f"count(DISTINCT {key})"),
        (f"{p}_total_row_count", "count(*)"))]


_RECONCILE_EVENTS = _metrics(
    _six(("DL", "DW"), "event_id") + [
        (f"{p}_null_pk_count", "count(*) FILTER (WHERE event_id IS NULL)") for p in ("DL", "DW")],
    "events", line=True)

_SESSIONS_30M = _sessions("user_id", "ts", "events", 1800, "user_id")

_EVENT_HOSPITAL_ROWS = f"""
    {_WITH_K},
    parts AS (SELECT * FROM (VALUES ('action', 'A'), ('button', 'B')) AS t(name, prefix)),
    places AS (SELECT * FROM (VALUES (0), (1)) AS t(position))
    SELECT concat('properties.', name, '.hospital[]') AS part, concat('m-', event_id) AS "messageId",
           CAST(position AS BIGINT) AS position,
           CASE WHEN position = 0 THEN CAST(k AS VARCHAR) ELSE concat(prefix, k) END AS value
    FROM e, parts, places WHERE k % 3 = 0 OR k % 3 = 1 AND position = 0"""

_LINES_OF_NESTED_ORDERS = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS at
    FROM lineitem"""

_COMPARE_EVENT_CONTENTS = f"""
    {_WITH_K}
    SELECT concat('m-', event_id) AS key, CASE WHEN k % 97 = 0 THEN 'missing' ELSE 'changed' END AS status,
           CAST(1 AS BIGINT) AS n_source, CAST(CASE WHEN k % 97 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_target
    FROM e WHERE k % 97 = 0 OR k % 89 = 1
    UNION ALL
    SELECT concat('x-m-', event_id), 'extra', CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM e WHERE k % 83 = 2"""

_DAILY_METRICS_HISTORY = """
    WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS value FROM events GROUP BY ALL),
    seen AS (
        SELECT *, lag(value) OVER w AS previous_value, CAST(day - lag(day) OVER w AS INTEGER) AS days_since,
               CAST(median(value) OVER f AS DOUBLE) AS usual_value, count(value) OVER f AS n_usual
        FROM daily
        WINDOW w AS (PARTITION BY event_type ORDER BY day),
               f AS (PARTITION BY event_type ORDER BY day
                     RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT *, CASE WHEN days_since IS NULL THEN 'first' WHEN days_since > 1 THEN 'after gap'
                   WHEN n_usual < 3 THEN 'new' WHEN value < usual_value * 0.75 THEN 'low'
                   WHEN value > usual_value * 1.25 THEN 'high' ELSE 'usual' END AS status
    FROM seen"""

ORACLES = {
    "event_hospital_rows": _EVENT_HOSPITAL_ROWS,
    "lines_of_nested_orders": _LINES_OF_NESTED_ORDERS,
    "compare_event_contents": _COMPARE_EVENT_CONTENTS,
    "daily_metrics_history": _DAILY_METRICS_HISTORY,
    "sessions_30m": _SESSIONS_30M,
    "sessions_by_load": _SESSIONS_30M,
    "sessions_6h": _sessions("user_id", "ts", "events", 21600, "user_id"),
    "sessions_of_types": _sessions(
        "event_type", "ts", "events", 300, "event_type", ", idle / 60.0 AS inactivity_time"),
    "sessions_all_events": _SESSIONS_ALL_EVENTS,
    "sessions_from_log": _sessions(
        "user_id", "ts",
        "(SELECT CAST(user_id AS VARCHAR) AS user_id, ts + INTERVAL 9 HOUR AS ts FROM events)",
        21600, '"anonymousId"'),
    "calendar_keys": _CALENDAR_KEYS,
    "calendar_keys_iso_local": _CALENDAR_KEYS_ISO_LOCAL,
    "calendar_keys_orders": _CALENDAR_KEYS_ORDERS,
    "flatten_events": _FLATTEN_EVENTS,
    "safe_columns": _SAFE_COLUMNS,
    "array_elements": """
        SELECT vec_id, embedding[1] AS "first", embedding[2] AS "second",
               embedding[100001] AS beyond
        FROM embeddings""",
    "auto_flatten": _AUTO_FLATTEN,
    "inferred_log": f"""
        {_WITH_K}
        SELECT concat('m-', event_id) AS "messageId", concat('/', event_type) AS context_page_url,
               concat('to-', k) AS properties_properties_to, {_USER} AS "userId"
        FROM e""",
    "case_tolerant_log": f"""
        {_WITH_K}
        SELECT CAST(user_id AS VARCHAR) AS "anonymousId", concat('m-', event_id) AS "messageId",
               concat('agent/', user_id % 5) AS user_agent, concat('/', event_type) AS page_url,
               {_hospital('A', 0)} AS hospital_id
        FROM e""",
    "log_of_spellings": f"""
        {_WITH_K}
        SELECT CAST(user_id AS VARCHAR) AS "anonymousId", concat('m-', event_id) AS "messageId",
               concat('agent/', user_id % 5) AS user_agent, concat('/', event_type) AS page_url,
               {_hospital('A', 0)} AS hospital_id, CAST(NULL AS VARCHAR) AS corrupt
        FROM e""",
    "nested_sql_top5": f"""
        {_WITH_K}
        SELECT concat('m-', event_id) AS messageid, CAST(user_id AS VARCHAR) AS anonymousid,
               concat('/', event_type) AS context_page_url,
               nullif({_hospital_list('A')}, '') AS hospital,
               concat('to-', k) AS properties_properties_to
        FROM e ORDER BY messageid LIMIT 5""",
    "not_null_hospitals": f"SELECT count(*) AS n FROM events WHERE {_K} % 3 IN (0, 1)",
    "largest_order": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
               o_totalprice
        FROM orders WHERE o_totalprice NOT IN (99.99, 999.9, 9999.9)
        ORDER BY o_totalprice DESC, o_orderkey DESC, o_custkey DESC, o_orderdate DESC,
                 o_orderpriority DESC
        LIMIT 1""",
    "extremes_of_lines": _EXTREMES_OF_LINES,
    "extremes_from_csv": " UNION ALL ".join(f"""
        (SELECT '{name}' AS description, '{column}' AS column_name, o_orderkey,
                o_orderpriority, CAST({column} AS DOUBLE) AS value, '{unit}' AS units,
                concat('{name}: order ', o_orderkey, ' (', o_orderpriority, ')') AS line
         FROM orders WHERE {column} NOT IN (99.99, 999.9, 9999.9)
         ORDER BY {column} DESC, o_orderkey DESC, o_orderpriority DESC LIMIT 1)"""
        for name, column, unit in (("Highest order", "o_totalprice", "USD"), ("Highest customer", "o_custkey", ""))),
    "reconcile_events": _RECONCILE_EVENTS,
    "reconcile_sessions": _metrics(
        [(f"{p}_{m}_count", "count(*)") for p in ("DL", "DW") for m in ("pk", "total_row")],
        f"({_SESSIONS_30M})"),
    "malformed_lines": _metrics(
        [("DL_pk_count", "count(*)"),
         ("distinct_DL_pk_count", f"count(DISTINCT event_id) FILTER (WHERE {_K} % 10 <> 0) "
                                  f"+ CASE WHEN count(*) FILTER (WHERE {_K} % 10 = 0) > 0 THEN 1 ELSE 0 END"),
         ("DL_total_row_count", "count(*)"),
         ("DL_null_pk_count", f"count(*) FILTER (WHERE {_K} % 10 = 0)"),
         ("DL_corrupt_count", f"count(*) FILTER (WHERE {_K} % 10 = 0)")], "events"),
    "rejected_lines": f"""
        SELECT 'accepted' AS part, concat('m-', event_id) AS content FROM events WHERE {_K} % 10 <> 0
        UNION ALL
        SELECT 'rejected', substring(concat('{{"anonymousId":"', user_id, '","context":{{"userAgent":"agent/', user_id % 5), 1, 40)
        FROM events WHERE {_K} % 10 = 0
        UNION ALL
        SELECT 'counted', CAST(count(*) AS VARCHAR) FROM events WHERE {_K} % 10 = 0""",
    "persisted_counts": "SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM events",
    "compare_users": """
        WITH c AS (SELECT count(*) AS n, count(DISTINCT user_id) AS d FROM events),
        m AS (SELECT 'pk_count' AS metric, n AS v, n FROM c
              UNION ALL SELECT 'distinct_pk_count', d, n FROM c
              UNION ALL SELECT 'total_row_count', n, n FROM c)
        SELECT metric, v AS source_value, v AS target_value, true AS matches,
               n AS rows_seen_by_write
        FROM m""",
    "daily_load_metrics": _metrics(_six(("DL", "DW"), "event_id"), "events"),
    "csv_roundtrip": "SELECT * FROM supplier",
    "gzip_json_roundtrip": "SELECT * FROM customer",
    "distinct_types": "SELECT DISTINCT event_type FROM events",
    "day_volume": f"""
        SELECT {_DAY_MS} AS day_ms, count(*) AS n_events,
               round(CAST(sum(length(props)) AS DOUBLE) / 1024, 2) AS props_kb,
               {_DAY_MS} + 86400000 AS next_day_ms
        FROM events GROUP BY ALL""",
    "missing_user_days": f"""
        WITH present AS (SELECT DISTINCT user_id, {_DAY_MS} AS day_ms FROM events),
        calendar AS (SELECT unnest(generate_series(min(day_ms), max(day_ms), 86400000)) AS day_ms
                     FROM present),
        users AS (SELECT DISTINCT user_id FROM present)
        SELECT user_id, day_ms FROM users, calendar EXCEPT SELECT user_id, day_ms FROM present""",
    "missing_user_ranges": f"""
        WITH present AS (SELECT DISTINCT user_id, {_DAY_MS} AS day_ms FROM events),
        calendar AS (SELECT unnest(generate_series(min(day_ms), max(day_ms), 86400000)) AS day_ms FROM present),
        absent AS (SELECT user_id, day_ms FROM (SELECT DISTINCT user_id FROM present), calendar
                   EXCEPT SELECT user_id, day_ms FROM present),
        islands AS (SELECT *, day_ms - 86400000 * row_number() OVER (PARTITION BY user_id ORDER BY day_ms) AS island
                    FROM absent)
        SELECT user_id, min(day_ms) AS first_missing, max(day_ms) AS last_missing, count(*) AS n_days
        FROM islands GROUP BY user_id, island""",
    "events_of_days": f"""
        SELECT way, concat('m-', event_id) AS "messageId"
        FROM events, (VALUES ('folders'), ('filter')) AS w(way)
        WHERE {_DAY_MS} IN (1704240000000, 1704326400000, 1704844800000)""",
    "event_folder_names": f"""
        SELECT DISTINCT 1 AS level, concat('source=', event_type) AS folder FROM events
        UNION ALL SELECT DISTINCT 2, concat('day_ms=', {_DAY_MS}) FROM events""",
    "metric_file_preview": """
        WITH daily AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS metric, count(*) AS value
                       FROM events GROUP BY ALL)
        SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY metric) AS row_in_file,
               metric, value
        FROM daily QUALIFY row_in_file <= 5""",
    "ingest_daily_stream": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS ymd, count(*) AS n_events,
               count(DISTINCT event_id) AS n_messages,
               min({_LOCAL}) AS first_local, max({_LOCAL}) AS last_local
        FROM events GROUP BY ALL""",
    "ingested_file_status": f"""
        SELECT DISTINCT {_DAY_MS} AS day_ms,
               CASE WHEN {_DAY_MS} // 86400000 % 2 = 1 THEN 'loaded' ELSE 'new' END AS status
        FROM events""",
    "stream_user_sessions": """
        WITH marked AS (
            SELECT user_id, ts,
                   coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                            > INTERVAL 30 MINUTE, true) AS is_start
            FROM events),
        numbered AS (
            SELECT *, count(*) FILTER (WHERE is_start) OVER (PARTITION BY user_id ORDER BY ts) AS n
            FROM marked)
        SELECT user_id, min(ts) AS session_start_at, max(ts) AS last_event_at, count(*) AS n_events
        FROM numbered GROUP BY user_id, n""",
}
