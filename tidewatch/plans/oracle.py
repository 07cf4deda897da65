"""The registered queries as SQL for an independent engine.

The SQL is written in the plain form: one pass per window length, one unpartitioned ordered frame.
"""

from __future__ import annotations

from tidewatch.plans import fixture
from tidewatch.plans.registry import (
    EARLIER,
    EARLIER_LOOKBACK,
    FAR_DAYS,
    LATE_MODULO,
    LOOKBACK,
    OPEN,
    SLICE,
    VANISHED,
)

EDITS = """
edits AS (
  SELECT
    CASE WHEN event_id % 97 <> 0 THEN event_id END AS id,
    'Page_' || k AS title,
    'enwiki' AS wiki,
    k % 16 AS namespace,
    CASE WHEN event_id % 89 <> 0 THEN 'user_' || user_id END AS "user",
    CASE WHEN event_id % 83 <> 0 THEN user_id % 5 = 0 END AS bot,
    event_type = 'view' AS minor,
    epoch_us(ts) // 1000000 AS "timestamp",
    CASE event_type WHEN 'error' THEN 'Undid revision 1' WHEN 'click' THEN 'rv vandalism'
      WHEN 'signup' THEN 'Reverted edits by X' WHEN 'purchase' THEN '' END AS comment,
    CASE WHEN event_type <> 'signup' THEN 1000 END AS length_old,
    CAST(1000 + CASE WHEN event_type IN ('error', 'click') THEN -1 ELSE 1 END * floor(value)
      AS INTEGER) AS length_new,
    event_id AS revision_old,
    event_id + 1 AS revision_new,
    'en.wikipedia.org' AS server_name
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
)"""

# events whose text is spoiled: the first rule that fits wins
SPOILED = "CASE " + " ".join(
    f"WHEN revision_old % {modulo} = 0 THEN '{name}'" for name, modulo in fixture.SPOILED.items()
) + " ELSE 'sound' END"
DROPPED = "'empty', 'blank', 'truncated', 'scalar', 'array'"

ROUTED = f"""{EDITS},
routed AS (
  SELECT * REPLACE (
      CASE WHEN state IN ('no length', 'null length') THEN NULL ELSE length_old END AS length_old,
      CASE WHEN state IN ('no length', 'null length') THEN NULL ELSE length_new END AS length_new,
      CASE WHEN state = 'no comment' THEN '' ELSE comment END AS comment,
      CASE WHEN state = 'mistyped id' THEN NULL ELSE id END AS id),
    CASE WHEN revision_old % 10 <= 6 THEN 'wiki_edits' ELSE 'wiki_page_events' END AS topic,
    CASE WHEN state = 'mistyped id' THEN 'x' ELSE coalesce(CAST(id AS VARCHAR), 'None') END AS key,
    CASE WHEN state = 'mistyped id' THEN CAST('"x"' AS JSON) ELSE to_json(id) END AS id_json,
    CASE WHEN revision_old % 10 = 8 THEN 'delete' END AS log_type,
    CASE WHEN revision_old % 10 = 8 THEN 'restore' END AS log_action
  FROM (SELECT *, {SPOILED} AS state FROM edits)
  WHERE revision_old % 10 <> 9 AND revision_old % 13 <> 0 AND revision_old % 29 <> 0
    AND state NOT IN ({DROPPED})
)"""

# where bronze rows came from, as the registry sets it, and whether their stamp is set
ARRIVAL = """make_timestamp("timestamp" * 1000000) AS kafka_timestamp, "timestamp" AS "offset",
  CAST("timestamp" % 8 AS INTEGER) AS "partition", true AS ingested_at_set"""

SILVER = f"""{EDITS},
silver AS (
  SELECT *,
    CAST(hour(edit_timestamp) AS INTEGER) AS edit_hour,
    CAST(dayofweek(edit_timestamp) + 1 AS INTEGER) AS edit_day_of_week,
    length_new - length_old AS bytes_delta,
    abs(length_new - length_old) AS abs_bytes_delta,
    CASE namespace WHEN 0 THEN 'Article' WHEN 1 THEN 'Talk' WHEN 2 THEN 'User'
      WHEN 3 THEN 'User_Talk' WHEN 4 THEN 'Wikipedia' WHEN 5 THEN 'Wikipedia_Talk'
      WHEN 6 THEN 'File' WHEN 7 THEN 'File_Talk' WHEN 10 THEN 'Template'
      WHEN 11 THEN 'Template_Talk' WHEN 14 THEN 'Category' WHEN 15 THEN 'Category_Talk'
      ELSE 'Other' END AS namespace_label,
    coalesce(regexp_matches(comment, '(?i)\\b(revert|rv|rvv|undid)\\b'), false) AS is_revert
  FROM (SELECT *, make_timestamp("timestamp" * 1000000) AS edit_timestamp FROM edits)
  WHERE id IS NOT NULL AND "timestamp" IS NOT NULL
)"""


def _volume(label: str, source: str) -> str:
    minutes = label.removesuffix("min")
    return f"""
  SELECT *, round(bot_edits / total_edits, 4) AS bot_ratio,
    CAST(window_start AS DATE) AS date
  FROM (
    SELECT
      count(*) AS total_edits,
      CAST(sum(CAST(bot AS INTEGER)) AS BIGINT) AS bot_edits,
      CAST(sum(CAST(NOT bot AS INTEGER)) AS BIGINT) AS human_edits,
      count(DISTINCT "user") AS unique_users,
      CAST(sum(abs_bytes_delta) AS BIGINT) AS total_bytes_changed,
      round(avg(abs_bytes_delta), 6) AS avg_bytes_per_edit,
      CAST(sum(CAST(is_revert AS INTEGER)) AS BIGINT) AS revert_count,
      time_bucket(INTERVAL '{minutes} minute', edit_timestamp) AS window_start,
      time_bucket(INTERVAL '{minutes} minute', edit_timestamp) + INTERVAL '{minutes} minute'
        AS window_end,
      '{label}' AS window_duration
    FROM {source} GROUP BY window_start)"""


def _flagged(label: str, source: str, hours: int = 1, sigma: float = 2.0) -> str:
    return _flagged_of(_volume(label, source), hours, sigma)


def _flagged_of(volume: str, hours: int = 1, sigma: float = 2.0, exact: bool = False) -> str:
    above = f"total_edits > mean + {sigma} * spread"
    if exact:
        gap = "(n * total_edits - s)"
        above = f"{gap} > 0 AND {gap} * {gap} * (n - 1) > {int(sigma**2)} * n * (n * q - s * s)"
    return f"""
  SELECT * EXCLUDE (mean, spread, n, s, q),
    round(mean, 6) AS rolling_mean_edits,
    round(spread, 6) AS rolling_stddev_edits,
    round(mean + {sigma} * spread, 6) AS anomaly_threshold,
    {above} AS is_anomaly,
    round(CASE WHEN spread > 0 THEN (total_edits - mean) / spread ELSE 0.0 END, 6) AS z_score
  FROM (
    SELECT *, avg(total_edits) OVER past AS mean,
      coalesce(stddev_samp(total_edits) OVER past, 0.0) AS spread,
      count(*) OVER past AS n, sum(total_edits) OVER past AS s,
      sum(total_edits * total_edits) OVER past AS q
    FROM ({volume})
    WINDOW past AS (ORDER BY window_start
      RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW))"""


def _gold(source: str = "silver", name: str = "gold") -> str:
    return f"""
{name} AS (
  {_flagged("1min", source)}
  UNION ALL BY NAME
  {_flagged("5min", source)}
)"""


def _users(label: str, source: str) -> str:
    minutes = label.removesuffix("min")
    return f"""
  SELECT "user", bot,
    count(*) AS edit_count,
    CAST(sum(abs_bytes_delta) AS BIGINT) AS bytes_changed,
    CAST(sum(CAST(is_revert AS INTEGER)) AS BIGINT) AS revert_count,
    count(DISTINCT title) AS unique_pages_edited,
    time_bucket(INTERVAL '{minutes} minute', edit_timestamp) AS window_start,
    time_bucket(INTERVAL '{minutes} minute', edit_timestamp) + INTERVAL '{minutes} minute'
      AS window_end,
    '{label}' AS window_duration,
    CAST(time_bucket(INTERVAL '{minutes} minute', edit_timestamp) AS DATE) AS date
  FROM {source} GROUP BY window_start, "user", bot"""


def _activity(source: str = "silver") -> str:
    return f"""
activity AS (
  {_users("1min", source)}
  UNION ALL BY NAME
  {_users("5min", source)}
)"""


VOLUME_COLUMNS = """window_start, window_end, total_edits, bot_edits, human_edits, bot_ratio,
  unique_users, total_bytes_changed, avg_bytes_per_edit, revert_count, is_anomaly, z_score,
  rolling_mean_edits, anomaly_threshold"""
USER_COLUMNS = """window_start, "user", bot, edit_count, bytes_changed, revert_count,
  unique_pages_edited"""
SILVER_ROWS = f"WITH {SILVER} SELECT * FROM silver"
MESSAGE_JSON = {
    "wiki_edits": "json_object('id', id_json, 'title', title, 'wiki', wiki, 'namespace', namespace, "
    "'user', \"user\", 'bot', bot, 'minor', minor, 'timestamp', \"timestamp\", 'comment', comment, "
    "'length_old', length_old, 'length_new', length_new, 'revision_old', revision_old, "
    "'revision_new', revision_new, 'server_name', server_name)",
    "wiki_page_events": "json_object('id', id_json, 'title', title, 'wiki', wiki, 'namespace', "
    "namespace, 'user', \"user\", 'bot', bot, 'timestamp', \"timestamp\", 'comment', comment, "
    "'log_type', log_type, 'log_action', log_action, 'server_name', server_name)",
}


def _messages(topic: str) -> str:
    return (
        f"SELECT topic, key, CAST({MESSAGE_JSON[topic]} AS VARCHAR) AS value "
        f"FROM routed WHERE topic = '{topic}'"
    )


GOLD = f"WITH {SILVER}, {_gold()}"
USERS = f"WITH {SILVER}, {_activity()}"
# the 5-minute rows, whole table
ROWS = f"{GOLD}, rows_5 AS (SELECT * FROM gold WHERE window_duration = '5min')"
ANOMALY_USERS = f"""{ROWS}, {_activity()},
anomaly_users AS (
  SELECT {USER_COLUMNS} FROM activity
  WHERE window_duration = '5min'
    AND window_start IN (SELECT window_start FROM rows_5 WHERE is_anomaly)
)"""
SINCE = f"date >= DATE '{SLICE.date()}' AND window_start >= TIMESTAMP '{SLICE}'"

# edits that come in time for their window, and what a stream has closed at the end
ON_TIME = f"""on_time AS (
  SELECT * FROM silver
  WHERE revision_old % {LATE_MODULO} <> 0 OR edit_timestamp >= TIMESTAMP '{EARLIER_LOOKBACK}'
), closed AS (
  SELECT * FROM ({_volume("1min", "on_time")} UNION ALL BY NAME {_volume("5min", "on_time")})
  WHERE window_end <= (SELECT max(edit_timestamp) FROM silver) - INTERVAL '{OPEN}'
)"""


def _dense(label: str) -> str:
    """The volume of silver with a row for every window between the first and the last one."""
    minutes = label.removesuffix("min")
    step = f"INTERVAL '{minutes} minute'"
    zeros = ", ".join(
        f"CASE WHEN v.total_edits IS NULL THEN 0 ELSE v.{name} END AS {name}"
        for name in (
            "total_edits", "bot_edits", "human_edits", "unique_users", "total_bytes_changed",
            "revert_count",
        )
    )
    return f"""
  SELECT {zeros}, avg_bytes_per_edit, c.window_start,
    c.window_start + {step} AS window_end, '{label}' AS window_duration, bot_ratio,
    CAST(c.window_start AS DATE) AS date
  FROM (
    SELECT unnest(generate_series(min(window_start), max(window_start), {step})) AS window_start
    FROM v_{label}
  ) AS c LEFT JOIN v_{label} AS v USING (window_start)"""


ORACLE: dict[str, str] = {
    "ingest_route_counts": f"WITH {ROUTED} SELECT topic, count(*) AS messages FROM routed "
    "GROUP BY topic",
    "ingest_edit_messages": f"WITH {ROUTED} {_messages('wiki_edits')}",
    "ingest_page_messages": f"WITH {ROUTED} {_messages('wiki_page_events')}",
    "bronze_edits": f"""WITH {ROUTED} SELECT id, title, wiki, namespace, "user", bot, minor,
  "timestamp", comment, length_old, length_new, revision_old, revision_new, server_name,
  {ARRIVAL}
  FROM routed WHERE topic = 'wiki_edits'""",
    "bronze_page_events": f"""WITH {ROUTED} SELECT id, title, wiki, namespace, "user", bot,
  "timestamp", comment, log_type, log_action, server_name, {ARRIVAL}
  FROM routed WHERE topic = 'wiki_page_events'""",
    "silver_edits": f"WITH {SILVER} SELECT *, true AS silver_processed_at_set FROM silver",
    "silver_report": f"""WITH {SILVER} SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE is_revert) AS revert_rows, count(*) FILTER (WHERE bot) AS bot_rows,
  count(*) FILTER (WHERE is_revert) / count(*) * 100 AS revert_pct,
  count(*) FILTER (WHERE bot) / count(*) * 100 AS bot_pct FROM silver""",
    "namespace_breakdown": f"""WITH {SILVER} SELECT namespace_label, count(*) AS count
  FROM silver GROUP BY namespace_label""",
    "lookback_slice": f"{SILVER_ROWS} WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'",
    "time_range": f"""WITH {SILVER} SELECT min(edit_timestamp) AS earliest,
  max(edit_timestamp) AS latest FROM silver WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'""",
    "edit_volume_1min": f"WITH {SILVER} {_volume('1min', 'silver')}",
    "edit_volume_5min": f"WITH {SILVER} {_volume('5min', 'silver')}",
    "gold_edit_volume": f"{GOLD} SELECT * FROM gold",
    "gold_edit_volume_lookback": f"{GOLD} SELECT * FROM gold WHERE date >= DATE '{LOOKBACK}'",
    "gold_edit_volume_lookback_cold": f"""WITH {SILVER},
recent AS (SELECT * FROM silver WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'),
{_gold("recent")} SELECT * FROM gold""",
    "anomaly_summary": f"""{GOLD} SELECT count(*) AS total_windows,
  count(*) FILTER (WHERE is_anomaly) AS anomalous_windows,
  count(*) FILTER (WHERE is_anomaly) / count(*) * 100 AS anomalous_pct FROM gold""",
    "volume_table_report": f"""{GOLD} SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE is_anomaly) AS anomalous_rows FROM gold""",
    "rows_per_granularity": f"""{GOLD} SELECT window_duration, count(*) AS count FROM gold
  GROUP BY window_duration""",
    "gold_user_activity": f"{USERS} SELECT * FROM activity",
    "user_table_report": f"""{USERS} SELECT count(*) AS total_rows,
  (SELECT count(*) FROM (SELECT DISTINCT "user" FROM activity)) AS distinct_users FROM activity""",
    "editor_preview": f"""{USERS} SELECT window_start, "user", bot, edit_count,
  unique_pages_edited FROM activity WHERE window_duration = '5min'
  ORDER BY window_start, edit_count DESC, "user", bot LIMIT 10""",
    "latest_windows": f"""{GOLD} SELECT * FROM gold
  ORDER BY window_start DESC, window_duration LIMIT 20""",
    "volume_slice": f"""{GOLD} SELECT {VOLUME_COLUMNS} FROM gold
  WHERE window_duration = '5min' AND {SINCE} ORDER BY window_start""",
    "volume_slice_sql": f"""{GOLD} SELECT {VOLUME_COLUMNS} FROM gold
  WHERE window_duration = '1min' AND {SINCE} ORDER BY window_start""",
    "user_slice": f"""{USERS} SELECT {USER_COLUMNS} FROM activity
  WHERE window_duration = '5min' AND {SINCE} ORDER BY window_start, edit_count DESC""",
    "user_slice_sql": f"""{USERS} SELECT {USER_COLUMNS} FROM activity
  WHERE window_duration = '1min' AND {SINCE} ORDER BY window_start, edit_count DESC""",
    "kpis": f"""{ROWS} SELECT count(*) AS windows, CAST(sum(total_edits) AS BIGINT) AS total_edits,
  count(*) FILTER (WHERE is_anomaly) AS anomalous_windows,
  round(avg(bot_ratio), 6) AS avg_bot_ratio, max(total_edits) AS peak_edits,
  count(*) FILTER (WHERE is_anomaly) / count(*) * 100 AS anomalous_pct FROM rows_5""",
    "slice_users": f"""{USERS} SELECT count(DISTINCT "user") AS unique_users FROM activity
  WHERE window_duration = '5min'""",
    "volume_series": f"""{ROWS} SELECT window_start, total_edits, rolling_mean_edits,
  anomaly_threshold, CASE WHEN is_anomaly THEN total_edits END AS anomaly_edits FROM rows_5""",
    "bot_series": f"{ROWS} SELECT window_start, human_edits, bot_edits, bot_ratio FROM rows_5",
    "zscore_series": f"{ROWS} SELECT window_start, z_score FROM rows_5",
    "anomaly_users": f"{ANOMALY_USERS} SELECT * FROM anomaly_users",
    "top_editors": f"""{ANOMALY_USERS} SELECT "user", bot,
  CAST(sum(edit_count) AS BIGINT) AS edit_count, count(DISTINCT window_start) AS windows,
  CAST(sum(unique_pages_edited) AS BIGINT) AS unique_pages,
  "user" || CASE WHEN bot THEN ' 🤖' ELSE '' END AS label
  FROM anomaly_users WHERE "user" IS NOT NULL AND bot IS NOT NULL
  GROUP BY "user", bot ORDER BY edit_count DESC, "user", bot LIMIT 20""",
    "anomaly_table": f"""{ROWS} SELECT window_start, window_end, total_edits, bot_edits,
  human_edits, bot_ratio, z_score, revert_count FROM rows_5 WHERE is_anomaly""",
    "stream_ingest": f"WITH {ROUTED} {_messages('wiki_edits')} UNION ALL "
    f"{_messages('wiki_page_events')}",
    "stream_ingest_sse": f"WITH {ROUTED} {_messages('wiki_edits')} UNION ALL "
    f"{_messages('wiki_page_events')}",
    "stream_bronze_silver": f"""WITH {SILVER} SELECT *, true AS ingested_at_set,
  true AS silver_processed_at_set FROM silver""",
    "stream_bronze_pages": f"""WITH {ROUTED} SELECT id, title, wiki, namespace, "user", bot,
  "timestamp", comment, log_type, log_action, server_name, true AS ingested_at_set
  FROM routed WHERE topic = 'wiki_page_events'""",
    "first_windows": f"""{ROWS} SELECT {VOLUME_COLUMNS} FROM rows_5
  ORDER BY window_start LIMIT 20""",
    "gold_edit_volume_10min": f"WITH {SILVER} {_flagged('10min', 'silver', 2, 1.5)}",
    "gold_edit_volume_by_bot": f"""WITH {SILVER}
  SELECT true AS bot, * FROM ({_flagged("5min", "(SELECT * FROM silver WHERE bot)")})
  UNION ALL BY NAME
  SELECT false AS bot, * FROM ({_flagged("5min", "(SELECT * FROM silver WHERE NOT bot)")})
  UNION ALL BY NAME
  SELECT CAST(NULL AS BOOLEAN) AS bot, *
  FROM ({_flagged("5min", "(SELECT * FROM silver WHERE bot IS NULL)")})""",
    # the second run looks at a time without edits and writes nothing
    "refresh_nothing_new": f"""WITH {SILVER},
seen AS (SELECT * FROM silver WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'),
{_activity("seen")} SELECT * FROM activity""",
    # of the second run, one date is gone and its edits come back 32,768 days later
    "refresh_vanished_dates": f"""WITH {SILVER},
kept AS (
  SELECT * FROM silver
  WHERE edit_timestamp >= TIMESTAMP '{EARLIER_LOOKBACK}' AND edit_timestamp < TIMESTAMP '{LOOKBACK}'
  UNION ALL
  SELECT * FROM silver WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'
    AND CAST(edit_timestamp AS DATE) <> DATE '{VANISHED}'
  UNION ALL
  SELECT * REPLACE (edit_timestamp + INTERVAL {FAR_DAYS} DAY AS edit_timestamp) FROM silver
  WHERE CAST(edit_timestamp AS DATE) = DATE '{VANISHED}'
),
{_activity("kept")} SELECT * FROM activity""",
    # dates before the second lookback keep what the first run wrote
    "refresh_partitions": f"""WITH {SILVER},
kept AS (
  SELECT * FROM silver
  WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}' OR
    (edit_timestamp >= TIMESTAMP '{EARLIER_LOOKBACK}' AND edit_timestamp < TIMESTAMP '{EARLIER}')
),
{_activity("kept")} SELECT * FROM activity""",
    "refresh_volume_partitions": f"""WITH {SILVER},
seen AS (SELECT * FROM silver WHERE edit_timestamp >= TIMESTAMP '{EARLIER_LOOKBACK}'
  AND edit_timestamp < TIMESTAMP '{EARLIER}'),
{_gold("seen", "first_run")},
recent AS (SELECT * FROM silver WHERE edit_timestamp >= TIMESTAMP '{LOOKBACK}'),
{_gold("recent", "second_run")}
SELECT * FROM first_run WHERE date < DATE '{LOOKBACK}'
UNION ALL BY NAME SELECT * FROM second_run""",
    # late edits of any age reach gold
    "refresh_late_edits": f"{GOLD} SELECT * FROM gold",
    "stream_edit_volume": f"WITH {SILVER}, {ON_TIME} SELECT * EXCLUDE (unique_users) FROM closed",
    "stream_late_counts": f"""WITH {SILVER}, {ON_TIME}, every AS (
  {_volume("1min", "silver")} UNION ALL BY NAME {_volume("5min", "silver")}
), ends AS (SELECT window_duration, max(window_end) AS last FROM closed GROUP BY window_duration)
SELECT window_duration, window_start, coalesce(closed.total_edits, 0) AS counted_edits,
  every.total_edits - coalesce(closed.total_edits, 0) AS late_edits
FROM every JOIN ends USING (window_duration)
LEFT JOIN closed USING (window_duration, window_start)
WHERE every.window_end <= last AND every.total_edits > coalesce(closed.total_edits, 0)""",
    "stream_anomalies": f"""{GOLD} SELECT window_duration, window_start, total_edits,
  rolling_mean_edits, rolling_stddev_edits, anomaly_threshold, is_anomaly, z_score FROM gold
  WHERE window_start <= (SELECT max(window_start) FROM gold) - INTERVAL '{OPEN}'""",
    "stream_silver_distinct": SILVER_ROWS,
    "sketched_users": f"""WITH {SILVER} SELECT window_duration,
  CAST(edit_timestamp AS DATE) AS date, count(DISTINCT "user") AS exact_users, true AS within_3_pct
  FROM silver, (VALUES ('1min'), ('5min')) AS labels(window_duration) GROUP BY ALL""",
    "processing_latency": f"""WITH {SILVER}, timed AS (
  SELECT CAST(edit_timestamp AS DATE) AS date, 1000 * CASE {" ".join(
      f"WHEN revision_old * 7919 % 1000 < {below} THEN {seconds}" for below, seconds in fixture.LAGS
  )} END AS ms FROM silver)
SELECT date, count(*) AS timed_edits, max(ms)::BIGINT AS max_latency_ms,
  quantile_disc(ms, 0.5)::BIGINT AS p50_ms, quantile_disc(ms, 0.95)::BIGINT AS p95_ms,
  quantile_disc(ms, 0.99)::BIGINT AS p99_ms FROM timed GROUP BY date""",
    "gold_edit_volume_dense": f"""WITH {SILVER}, v_1min AS ({_volume("1min", "silver")}),
v_5min AS ({_volume("5min", "silver")}),
dense AS ({_flagged_of(_dense("1min"), exact=True)} UNION ALL BY NAME {_flagged_of(_dense("5min"), exact=True)})
SELECT * FROM dense""",
    "silver_edits_lookup": f"""WITH {SILVER} SELECT * REPLACE (CASE namespace {" ".join(
        f"WHEN {number} THEN '{label}'" for number, label in fixture.OWN_LABELS if label
    )} ELSE 'None' END AS namespace_label) FROM silver""",
}
ORACLE["refresh_versions"] = ORACLE["refresh_volume_partitions"]
