"""Reference SQL for the registered queries, in DuckDB's dialect, written independently of the Spark code.

``_PARTS`` are named sub-selects, ``_BODIES`` one final select per query; a statement is the body
with the parts it refers to, directly or through other parts.
"""

from __future__ import annotations

import re

from stridelake.plans.registry import ADHOC

_SILVER = (
    "user_id, timestamp, steps, calories, intensity, sleep_value, ingest_time, year, month, day, "
    "hour_of_day, day_of_week, is_active, is_sleeping"
)
_VALUES = "steps, calories, intensity, sleep_value, ingest_time, year, month, day, hour_of_day, day_of_week, is_active, is_sleeping, seq"


def _enrich(source: str, extra: str = "") -> str:
    return f"""
        SELECT user_id, timestamp, steps, calories, intensity, sleep_value, ingest_time,
               CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
               CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
               CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week,
               CASE WHEN steps > 10 THEN 1 ELSE 0 END AS is_active,
               CASE WHEN sleep_value IS NOT NULL THEN 1 ELSE 0 END AS is_sleeping{extra}
        FROM {source}"""


def _gold(source: str, full: bool = False) -> str:
    extra = """,
               CASE WHEN total_steps >= 5000 THEN 'LOW_RISK' WHEN total_steps >= 1000 THEN 'MEDIUM_RISK'
                    ELSE 'HIGH_RISK' END AS health_risk, 'v1.0' AS pipeline_version""" if full else ""
    return f"""
        SELECT user_id, year, month, day, total_steps, round(total_calories, 2) AS total_calories, active_minutes,
               sleep_minutes, round(avg_intensity, 4) AS avg_intensity, max_steps_in_minute, total_minutes_recorded,
               CAST(CASE WHEN total_steps > 15000 THEN 0.8 WHEN total_steps > 12000 THEN 0.5
                         WHEN total_steps = 0 THEN 0.3 ELSE 0.1 END AS DOUBLE) AS anomaly_score,
               CASE WHEN total_steps >= 10000 THEN 'HIGH' WHEN total_steps >= 5000 THEN 'MEDIUM'
                    WHEN total_steps >= 1000 THEN 'LOW' ELSE 'SEDENTARY' END AS activity_level{extra}
        FROM (SELECT user_id, year, month, day, CAST(sum(steps) AS BIGINT) AS total_steps,
                     sum(calories) AS total_calories, CAST(sum(is_active) AS BIGINT) AS active_minutes,
                     CAST(sum(is_sleeping) AS BIGINT) AS sleep_minutes, avg(intensity) AS avg_intensity,
                     max(steps) AS max_steps_in_minute, count(*) AS total_minutes_recorded
              FROM {source} GROUP BY user_id, year, month, day)"""


def _mask(column: str, chars: int = 8) -> str:
    return f"'USR_' || substr(sha256({column}), 1, {chars})"


def _message(kind: str = "event_type") -> str:
    """JSON text of a message, fields in their fixed order."""
    return (
        "'{\"user_id\":\"' || user_id || '\",\"day\":' || day || ',\"activity_date\":\"' || CAST(activity_date AS VARCHAR)"
        f" || '\",\"event_type\":\"' || {kind} || '\",\"message\":\"' || message || '\",\"priority\":\"' || priority"
        " || '\",\"points\":' || points || ',\"timestamp\":\"2024-02-01 00:00:00\"}'"
    )


_MINUTE_TEXT = "strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p')"

_BADGES = """
    (VALUES (100, 'First Step 🥉'), (500, '5 Day Warrior 🥈'), (1000, '10K Champion 🥇'),
            (5000, 'Fitness Legend 🏆')) AS b(threshold, badge)"""

_RULES = """
    (VALUES ('bronze', 'minute_data/', 90), ('gold', 'predictions/', 30), ('gold', 'cost-reports/', 365),
            ('silver', 'minute_data/', 365)) AS r(store, prefix, keep_days)"""

_ERRORS = """
    concat_ws('; ',
        CASE WHEN user_id IS NULL OR trim(user_id) = '' THEN 'Null value in: user_id' END,
        CASE WHEN timestamp IS NULL OR trim(timestamp) = '' THEN 'Null value in: timestamp' END,
        CASE WHEN steps IS NULL OR trim(steps) = '' THEN 'Null value in: steps' END,
        CASE WHEN calories IS NULL OR trim(calories) = '' THEN 'Null value in: calories' END,
        CASE WHEN TRY_CAST(steps AS BIGINT) IS NULL THEN 'Steps must be integer' END,
        CASE WHEN TRY_CAST(calories AS DOUBLE) IS NULL THEN 'Calories must be float' END,
        CASE WHEN try_strptime(timestamp, '%m/%d/%Y %I:%M:%S %p') IS NULL THEN 'Invalid timestamp format' END,
        CASE WHEN TRY_CAST(steps AS BIGINT) NOT BETWEEN 0 AND 200 THEN 'Steps out of range: ' || steps END,
        CASE WHEN TRY_CAST(steps AS BIGINT) IS NOT NULL AND TRY_CAST(calories AS DOUBLE) NOT BETWEEN 0 AND 20
             THEN 'Calories out of range: ' || calories END)"""

_PARTS: dict[str, str] = {
    # --- inputs ---
    "ev": """
        SELECT event_id, ts, user_id, event_type, value, k, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1
                    WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS intensity,
               CASE WHEN k < 25 THEN NULL WHEN k < 50 THEN 1 WHEN k < 75 THEN 2 ELSE 3 END AS sleep_value
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "raw": f"""
        SELECT CASE WHEN k = 97 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN k = 98 THEN 'bad' ELSE {_MINUTE_TEXT} END AS timestamp,
               CASE WHEN k = 99 THEN '-1' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS steps,
               CAST(floor(value) / 4.0 AS VARCHAR) AS calories, CAST(intensity AS VARCHAR) AS intensity,
               CAST(sleep_value AS VARCHAR) AS sleep_value, '2024-02-01 00:0' || copy || ':00' AS ingest_time
        FROM (SELECT *, unnest(CASE WHEN k < 10 THEN [0, 1] ELSE [0] END) AS copy FROM ev)""",
    "typed": """
        SELECT user_id, try_strptime(timestamp, '%m/%d/%Y %I:%M:%S %p') AS timestamp,
               TRY_CAST(steps AS INTEGER) AS steps, TRY_CAST(calories AS DOUBLE) AS calories,
               TRY_CAST(intensity AS INTEGER) AS intensity, TRY_CAST(sleep_value AS INTEGER) AS sleep_value, ingest_time
        FROM raw""",
    "cleaned": """
        SELECT * FROM typed
        WHERE timestamp IS NOT NULL AND steps >= 0 AND calories >= 0 AND user_id IS NOT NULL""",
    "deduped": """
        SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY user_id, timestamp ORDER BY ingest_time DESC,
            steps NULLS FIRST, calories NULLS FIRST, intensity NULLS FIRST, sleep_value NULLS FIRST) = 1""",
    "masked": f"SELECT * REPLACE ({_mask('user_id')} AS user_id) FROM deduped",
    "silver": _enrich("masked"),
    "scaled": f"""
        SELECT {_mask('CAST(user_id AS VARCHAR)')} AS user_id, ts AS timestamp,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) * 75 END AS steps,
               floor(value) / 4.0 AS calories, intensity, sleep_value, NULL AS ingest_time
        FROM ev""",
    "scaled_silver": _enrich("scaled"),
    "gold_full": _gold("scaled_silver", full=True),
    # --- daily ---
    "user_days": """
        SELECT user_id, CAST(ts AS DATE) AS activity_date,
               CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) * 75 END) AS BIGINT) AS daily_steps,
               CAST(floor(sum(floor(value) / 4.0)) AS BIGINT) AS daily_calories,
               CAST(25 * count(*) FILTER (WHERE event_type = 'purchase') + 15 * count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS VeryActiveMinutes,
               CAST(15 * count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS FairlyActiveMinutes,
               CAST(20 * count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS LightlyActiveMinutes,
               CAST(greatest(0, 1440 - 250 * count(*)) AS BIGINT) AS SedentaryMinutes,
               count(*) FILTER (WHERE event_type <> 'error') AS readings, count(*) FILTER (WHERE event_type <> 'signup') AS moves
        FROM ev GROUP BY ALL""",
    "fact": """
        SELECT user_id, activity_date, daily_calories, daily_steps, SedentaryMinutes, LightlyActiveMinutes,
               FairlyActiveMinutes, VeryActiveMinutes
        FROM user_days WHERE readings > 0 AND moves > 0""",
    "flags": """
        SELECT *, CASE WHEN met_steps_goal = 1 OR met_activity_goal = 1 THEN 1 ELSE 0 END AS is_engaged_day
        FROM (SELECT *, CASE WHEN daily_steps >= 8000 THEN 1 ELSE 0 END AS met_steps_goal,
                     CASE WHEN VeryActiveMinutes >= 30 THEN 1 ELSE 0 END AS met_activity_goal,
                     CASE WHEN SedentaryMinutes <= 600 THEN 1 ELSE 0 END AS low_sedentary FROM fact)""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY activity_date) AS n,
               row_number() OVER (PARTITION BY user_id, is_engaged_day ORDER BY activity_date) AS n_engaged,
               row_number() OVER (PARTITION BY user_id, low_sedentary ORDER BY activity_date) AS n_sedentary
        FROM flags""",
    # --- hourly ---
    "hourly": """
        SELECT Id, ts_hour, CAST(ts_hour AS DATE) AS activity_date, CAST(hour(ts_hour) AS INTEGER) AS activity_hour,
               steps AS StepTotal, CASE WHEN steps > 0 OR intensity > 0 THEN 1 ELSE 0 END AS is_active_hour
        FROM (SELECT user_id AS Id, date_trunc('hour', ts) AS ts_hour, CAST(sum(floor(value)) AS BIGINT) AS steps,
                     sum(intensity) AS intensity, count(*) FILTER (WHERE event_type <> 'error') AS readings FROM ev GROUP BY ALL)
        WHERE readings > 0""",
    "peak": """
        SELECT Id, activity_date, activity_hour AS peak_activity_hour FROM hourly
        QUALIFY row_number() OVER (PARTITION BY Id, activity_date ORDER BY StepTotal DESC, activity_hour) = 1""",
    # --- minute merge ---
    "merged": f"""
        SELECT s.user_id, s.timestamp, s.steps, c.calories, i.intensity, z.sleep_value
        FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, {_MINUTE_TEXT} AS timestamp,
                     CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS steps FROM ev WHERE k <> 11) s
        JOIN (SELECT CAST(user_id AS VARCHAR) AS user_id, {_MINUTE_TEXT} AS timestamp,
                     CAST(floor(value) / 20.0 AS VARCHAR) AS calories FROM ev WHERE k <> 12) c USING (user_id, timestamp)
        JOIN (SELECT CAST(user_id AS VARCHAR) AS user_id, {_MINUTE_TEXT} AS timestamp,
                     CAST(least(intensity, 3) AS VARCHAR) AS intensity FROM ev WHERE k <> 13) i USING (user_id, timestamp)
        LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS user_id, {_MINUTE_TEXT} AS timestamp,
                          CAST(unnest(CASE WHEN k >= 90 THEN [sleep_value, 2] ELSE [sleep_value] END) AS VARCHAR) AS sleep_value
                   FROM ev WHERE k >= 25) z USING (user_id, timestamp)""",
    # --- events ---
    "found": """
        SELECT user_id, day, make_date(year, month, day) AS activity_date, event_type,
               CASE event_type
                    WHEN 'FRAUD_DETECTED' THEN 'Suspicious activity! Steps: ' || total_steps || '.0'
                    WHEN 'WORKOUT_COMPLETED' THEN 'Amazing! You hit ' || total_steps || '.0 steps today!'
                    ELSE 'No steps today — time to move!' END AS message,
               CASE event_type WHEN 'FRAUD_DETECTED' THEN 'HIGH' WHEN 'WORKOUT_COMPLETED' THEN 'LOW' ELSE 'MEDIUM' END AS priority,
               CASE event_type WHEN 'WORKOUT_COMPLETED' THEN 100 ELSE 0 END AS points
        FROM (SELECT *, CASE WHEN anomaly_score >= 0.8 THEN 'FRAUD_DETECTED' WHEN total_steps >= 10000 THEN 'WORKOUT_COMPLETED'
                             WHEN total_steps = 0 THEN 'INACTIVITY_DETECTED' END AS event_type FROM gold_full)
        WHERE event_type IS NOT NULL""",
    "sent": """
        SELECT * EXCLUDE (event_type, kinds), unnest(kinds) AS event_type
        FROM (SELECT *, CASE WHEN event_type = 'FRAUD_DETECTED' THEN [event_type, 'LEVEL_CHANGED']
                             WHEN day <= 15 THEN [event_type, event_type] ELSE [event_type] END AS kinds FROM found)""",
    "decoded": f"""
        SELECT CASE WHEN NOT failed THEN user_id END AS user_id, CASE WHEN NOT failed THEN day END AS day,
               CASE WHEN NOT failed THEN activity_date END AS activity_date,
               CASE WHEN NOT failed THEN event_type END AS event_type, CASE WHEN NOT failed THEN message END AS message,
               CASE WHEN NOT failed THEN points END AS points, failed,
               CASE WHEN failed THEN 'broken ' || {_message()} END AS failed_body
        FROM (SELECT *, event_type = 'INACTIVITY_DETECTED' AND day > 25 AS failed FROM sent)""",
    "progress": """
        SELECT user_id, activity_date, day, points,
               CAST(sum(points) OVER w AS BIGINT) AS running_points, row_number() OVER w AS workout_number
        FROM (SELECT DISTINCT user_id, activity_date, day, points FROM found WHERE event_type = 'WORKOUT_COMPLETED')
        WINDOW w AS (PARTITION BY user_id ORDER BY activity_date ROWS UNBOUNDED PRECEDING)""",
    "unlocks": f"""
        SELECT p.user_id, p.activity_date, p.running_points, b.badge, b.threshold
        FROM progress p JOIN {_BADGES}
          ON p.running_points >= b.threshold AND p.running_points - p.points < b.threshold""",
    "state": """
        SELECT s.user_id, s.total_points, coalesce(u.badges, '') AS badges, s.workout_count,
               CAST(day(s.last_activity_date) AS INTEGER) AS last_day, s.last_activity_date
        FROM (SELECT user_id, CAST(sum(points) AS BIGINT) AS total_points, count(*) AS workout_count,
                     max(activity_date) AS last_activity_date FROM progress GROUP BY user_id) s
        LEFT JOIN (SELECT user_id, string_agg(badge, '|' ORDER BY threshold) AS badges FROM unlocks GROUP BY user_id) u
        USING (user_id)""",
    # --- change data ---
    "base": "SELECT *, 0 AS seq FROM silver",
    "changed": f"""
        SELECT {_SILVER}, seq, operation_type FROM ({_enrich('''(
            SELECT user_id, CASE WHEN intensity = 2 THEN timestamp + INTERVAL 30 DAY ELSE timestamp END AS timestamp,
                   CASE intensity WHEN 1 THEN 0 WHEN 3 THEN steps + 1 ELSE steps END AS steps, calories, intensity,
                   sleep_value, ingest_time, CASE intensity WHEN 1 THEN -1 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 3 END AS seq,
                   CASE intensity WHEN 2 THEN 'INSERT' WHEN 4 THEN 'DELETE' ELSE 'UPDATE' END AS operation_type
            FROM base WHERE intensity > 0)''', ', seq, operation_type')})""",
    "applied": f"""
        SELECT {_SILVER}, seq FROM (
            SELECT * FROM (SELECT {_SILVER}, seq, NULL AS operation_type FROM base
                           UNION ALL SELECT {_SILVER}, seq, operation_type FROM changed)
            QUALIFY row_number() OVER (PARTITION BY user_id, timestamp ORDER BY seq DESC) = 1)
        WHERE operation_type IS DISTINCT FROM 'DELETE'""",
    "lines": f"""
        SELECT *, CASE WHEN load = 1 THEN CAST(60 + k AS VARCHAR) END AS heart_rate FROM (
            SELECT CASE WHEN k = 97 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
                   CASE WHEN k = 98 THEN 'bad' ELSE {_MINUTE_TEXT} END AS timestamp,
                   CASE WHEN k = 99 THEN '-1' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS steps,
                   CAST(floor(value) / 4.0 AS VARCHAR) AS calories, CAST(intensity AS VARCHAR) AS intensity,
                   CAST(sleep_value AS VARCHAR) AS sleep_value, '2024-02-01 00:0' || copy || ':00' AS ingest_time, k,
                   CASE WHEN event_type IN ('view', 'click') THEN 0 WHEN event_type IN ('signup', 'purchase') THEN 1 ELSE 2 END AS load
            FROM (SELECT *, unnest(CASE WHEN k < 10 THEN [0, 1] ELSE [0] END) AS copy FROM ev))""",
    "bronze_rows": """
        SELECT load, k = 96 AS broken, CASE WHEN k <> 96 THEN user_id END AS user_id, CASE WHEN k <> 96 THEN timestamp END AS timestamp,
               CASE WHEN k <> 96 THEN steps END AS steps, CASE WHEN k <> 96 THEN calories END AS calories,
               CASE WHEN k <> 96 THEN intensity END AS intensity, CASE WHEN k <> 96 THEN sleep_value END AS sleep_value,
               CASE WHEN k <> 96 THEN ingest_time END AS ingest_time, CASE WHEN k <> 96 THEN heart_rate END AS heart_rate,
               CASE WHEN k = 96 THEN 'broken {' || concat_ws(',', '"user_id":"' || user_id || '"', '"timestamp":"' || timestamp || '"',
                   '"steps":"' || steps || '"', '"calories":"' || calories || '"', '"intensity":"' || intensity || '"',
                   '"sleep_value":"' || sleep_value || '"', '"ingest_time":"' || ingest_time || '"', '"heart_rate":' || heart_rate) || '}'
               END AS _corrupt_record, CAST(NULL AS VARCHAR) AS _rescued,
               try_strptime(CASE WHEN k <> 96 THEN timestamp END, '%m/%d/%Y %I:%M:%S %p') AS ts
        FROM lines""",
    "judged": """
        SELECT *, CASE WHEN broken THEN 'unreadable' ELSE concat_ws('; ', CASE WHEN ts IS NULL THEN 'timestamp_not_null' END,
            CASE WHEN TRY_CAST(steps AS INTEGER) >= 0 THEN NULL ELSE 'steps_not_negative' END,
            CASE WHEN TRY_CAST(calories AS DOUBLE) >= 0 THEN NULL ELSE 'calories_not_negative' END,
            CASE WHEN user_id IS NULL THEN 'user_id_not_null' END) END AS broken_rules
        FROM bronze_rows""",
    "first_late": "SELECT max(ts) - INTERVAL 20 DAY AS mark FROM judged WHERE load = 0 AND broken_rules = ''",
    "second_late": """
        SELECT max(ts) - INTERVAL 20 DAY AS mark FROM judged
        WHERE broken_rules = '' AND (load = 0 OR load = 1 AND ts >= (SELECT mark FROM first_late))""",
    "routed": """
        SELECT * EXCLUDE (broken_rules), concat_ws('; ', nullif(broken_rules, ''), CASE WHEN NOT broken AND ts <
            CASE load WHEN 1 THEN (SELECT mark FROM first_late) WHEN 2 THEN (SELECT mark FROM second_late) END THEN 'late' END) AS reasons
        FROM judged""",
    # --- retention ---
    "listing": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'bronze' WHEN 'O' THEN 'silver' ELSE 'gold' END AS store,
               CASE WHEN o_orderstatus = 'P' THEN 'predictions/' ELSE 'minute_data/' END || o_orderkey AS path,
               CAST(round(o_totalprice * 100) AS BIGINT) AS size_bytes, o_orderdate AS last_modified
        FROM orders""",
    "retention": f"""
        SELECT r.store, r.prefix, r.keep_days, count(l.path) AS deleted_files,
               CAST(coalesce(sum(l.size_bytes), 0) AS BIGINT) AS bytes_freed,
               round(coalesce(sum(l.size_bytes), 0) / 1024 / 1024, 2) AS mb_freed
        FROM {_RULES} LEFT JOIN listing l
          ON l.store = r.store AND starts_with(l.path, r.prefix)
         AND date_diff('day', l.last_modified, TIMESTAMP '2001-08-02 00:00:00') > r.keep_days
        GROUP BY r.store, r.prefix, r.keep_days""",
    # --- model ---
    "codes": "SELECT *, (total_steps % 50) / 10.0 AS raw_prediction FROM gold_full",
    "decoded_codes": """
        SELECT *, user_id AS uid, CAST(year AS VARCHAR) || '-' || month || '-' || day AS date,
               CASE round_even(raw_prediction, 0) WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LOW'
                    WHEN 3 THEN 'SEDENTARY' ELSE 'UNKNOWN' END AS rounded_level,
               CASE raw_prediction WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LOW'
                    WHEN 3 THEN 'SEDENTARY' ELSE 'UNKNOWN' END AS exact_level
        FROM codes""",
}


def _failed(layer: str, source: str, rules: dict[str, str], keys: str) -> str:
    """One line per catalog rule, one for rows that break any, one for surplus copies of a key."""
    lines = [
        f"SELECT '{layer}' AS layer, '{name}' AS rule, count(*) AS total_rows,"
        f" count(*) FILTER (WHERE ({test}) IS NOT TRUE) AS failed_rows FROM {source}"
        for name, test in {**rules, "valid_rows": " AND ".join(f"(({t}) IS TRUE)" for t in rules.values())}.items()
    ]
    complete = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    lines.append(
        f"SELECT '{layer}', 'no_duplicates', (SELECT count(*) FROM {source}),"
        f" CAST(coalesce(sum(n - 1), 0) AS BIGINT)"
        f" FROM (SELECT count(*) AS n FROM {source} WHERE {complete} GROUP BY {keys})"
    )
    return " UNION ALL ".join(lines)


_BRONZE_RULES = {
    "user_id_not_null": "user_id IS NOT NULL",
    "timestamp_not_null": "timestamp IS NOT NULL",
    "steps_0_200": "steps >= 0 AND steps <= 200",
    "calories_0_20": "calories >= 0 AND calories <= 20",
    "intensity_0_3": "intensity >= 0 AND intensity <= 3",
}
_SILVER_RULES = {
    "user_id_masked": "starts_with(user_id, 'USR_')",
    "timestamp_not_null": "timestamp IS NOT NULL",
    "year_2016_2026": "year >= 2016 AND year <= 2026",
}
_GOLD_RULES = {
    "total_steps_not_negative": "total_steps >= 0",
    "anomaly_score_0_1": "anomaly_score >= 0 AND anomaly_score <= 1",
    "activity_level_domain": "activity_level IN ('HIGH', 'MEDIUM', 'LOW', 'SEDENTARY')",
    "health_risk_domain": "health_risk IN ('LOW_RISK', 'MEDIUM_RISK', 'HIGH_RISK')",
}
_PARTS["gold_from_silver"] = _gold("silver", full=True)
_PARTS["gold_applied"] = _gold("applied", full=True)
_PARTS["quality_lines"] = " UNION ALL ".join(
    [
        _failed("bronze", "typed", _BRONZE_RULES, "user_id, timestamp"),
        _failed("silver", "silver", _SILVER_RULES, "user_id, timestamp"),
        _failed("gold", "gold_from_silver", _GOLD_RULES, "user_id, year, month, day"),
        """SELECT 'gold', 'complete_days', CAST(sum(span) AS BIGINT), CAST(sum(span - days) AS BIGINT)
           FROM (SELECT count(*) AS days, date_diff('day', min(d), max(d)) + 1 AS span
                 FROM (SELECT DISTINCT user_id, make_date(year, month, day) AS d FROM gold_from_silver) GROUP BY user_id)""",
    ]
)

_RULE_LINES = (
    ("valid_steps_range", "warn", _BRONZE_RULES["steps_0_200"]),
    ("valid_calories_range", "warn", _BRONZE_RULES["calories_0_20"]),
    ("user_id_not_null", "drop", _BRONZE_RULES["user_id_not_null"]),
    ("timestamp_not_null", "fail", _BRONZE_RULES["timestamp_not_null"]),
    ("valid_intensity", "drop", _BRONZE_RULES["intensity_0_3"]),
    ("steps_0_200", "warn", _BRONZE_RULES["steps_0_200"]),
    ("calories_0_20", "warn", _BRONZE_RULES["calories_0_20"]),
    ("intensity_0_3", "warn", _BRONZE_RULES["intensity_0_3"]),
)

_LAST_7 = "OVER (PARTITION BY user_id ORDER BY activity_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_BY_DAY = "OVER (PARTITION BY user_id ORDER BY activity_date)"
_WAREHOUSE = (
    "user_id, year, month, day, total_steps, total_calories, active_minutes, sleep_minutes, avg_intensity, "
    "max_steps_in_minute, total_minutes_recorded, anomaly_score, activity_level"
)

_FRAUD_FLAGS = """*, CASE WHEN anomaly_score >= 0.8 THEN 'FRAUD' ELSE 'CLEAN' END AS fraud_flag,
    CASE WHEN total_steps > 15000 THEN 'Steps exceed daily maximum'
         WHEN anomaly_score >= 0.8 THEN 'Anomaly score threshold exceeded' END AS fraud_reason"""

_BODIES: dict[str, str] = {
    # --- streams end up with the batch result ---
    "stream_silver": "SELECT * FROM silver",
    "stream_gold": _gold("silver"),
    "stream_rewards": "SELECT * FROM state",
    "profile_lookup": "SELECT * FROM state WHERE user_id IN (SELECT user_id FROM found WHERE event_type = 'FRAUD_DETECTED')",
    "stream_drift": "SELECT * EXCLUDE (load, broken, ts) FROM bronze_rows",
    "stream_quarantine": "SELECT * EXCLUDE (load, broken, ts) FROM routed WHERE reasons <> ''",
    "stream_bronze": """
        SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze_rows
        UNION ALL SELECT 'silver', count(*) FROM (SELECT DISTINCT user_id, ts FROM routed WHERE reasons = '')
        UNION ALL SELECT 'quarantine: ' || reason, count(*)
        FROM (SELECT unnest(string_split(reasons, '; ')) AS reason FROM routed WHERE reasons <> '') GROUP BY ALL""",
    "scan_parquet": "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
    "silver_typed": "SELECT * FROM typed",
    "silver_clean": "SELECT * FROM cleaned",
    "silver_dedup": "SELECT * FROM deduped",
    "mask_user": f"""
        SELECT DISTINCT user_id, {_mask('CAST(user_id AS VARCHAR)')} AS masked,
               {_mask('CAST(user_id AS VARCHAR)', 16)} AS masked_long FROM events""",
    "silver_enriched": "SELECT * FROM silver",
    "silver_expect_drop": """
        SELECT * FROM typed WHERE user_id IS NOT NULL AND timestamp IS NOT NULL AND intensity BETWEEN 0 AND 3""",
    "silver_quality_report": """
        SELECT (SELECT count(*) FROM typed) AS total_rows,
               (SELECT count(*) FROM typed WHERE timestamp IS NULL) AS null_timestamps,
               (SELECT count(*) FROM typed WHERE timestamp IS NOT NULL AND steps < 0) AS invalid_steps,
               (SELECT count(*) FROM typed WHERE timestamp IS NOT NULL AND calories < 0) AS invalid_calories,
               (SELECT count(*) FROM typed WHERE timestamp IS NOT NULL AND user_id IS NULL) AS null_user_ids,
               (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM deduped) AS duplicates_removed,
               (SELECT count(*) FROM deduped) AS final_rows""",
    "expectations_report": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, '{action}' AS action, count(*) AS total_rows,"
        f" count(*) FILTER (WHERE ({test}) IS NOT TRUE) AS failed_rows FROM typed"
        for name, action, test in _RULE_LINES
    ),
    "stream_expectations": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, '{'drop' if action == 'fail' else action}' AS action, count(*) AS total_rows,"
        f" count(*) FILTER (WHERE ({test}) IS NOT TRUE) AS failed_rows FROM typed"
        for name, action, test in _RULE_LINES[:5]
    ),
    "validate_events": f"SELECT *, {_ERRORS} AS errors FROM raw",
    "quarantine": f"SELECT * FROM (SELECT *, {_ERRORS} AS errors FROM raw) WHERE errors <> ''",
    "layer_quality": """
        SELECT *, CASE WHEN layer = 'bronze' AND rule = 'valid_rows' THEN 1 - failed_rows / total_rows > 0.99
                       ELSE failed_rows = 0 END AS ok FROM quality_lines""",
    "minute_merge": "SELECT * FROM merged",
    "bronze_event_json": f"""
        SELECT '{{"user_id":"' || user_id || '","timestamp":"' || timestamp || '","steps":' || steps || ',"calories":'
               || calories || ',"intensity":' || intensity || ',"sleep_value":' || coalesce(sleep_value, 'null')
               || ',"event_type":"minute_activity","source":"device_feed","ingest_time":"2024-02-01 00:00:00"}}' AS value
        FROM (SELECT *, {_ERRORS} AS errors FROM merged) WHERE errors = ''""",
    # --- gold ---
    "gold_daily": _gold("silver"),
    "gold_daily_full": "SELECT * FROM gold_full",
    "gold_fraud": f"SELECT {_FRAUD_FLAGS} FROM gold_full",
    "gold_insurance": f"""
        SELECT *, CASE WHEN insurance_risk_score <= 10 THEN 'DISCOUNT_10%' WHEN insurance_risk_score >= 90 THEN 'SURCHARGE_20%'
                       ELSE 'STANDARD' END AS premium_adjustment
        FROM (SELECT {_FRAUD_FLAGS}, CASE activity_level WHEN 'HIGH' THEN 10 WHEN 'MEDIUM' THEN 30 WHEN 'LOW' THEN 60
                     ELSE 90 END AS insurance_risk_score FROM gold_full)""",
    "silver_written": "SELECT * FROM silver",
    "gold_written": "SELECT * FROM gold_full",
    "managed_gold": "SELECT * FROM gold_full",
    "warehouse_daily_summary": f"SELECT {_WAREHOUSE} FROM gold_full",
    "warehouse_count": "SELECT count(*) AS row_count FROM gold_full",
    # --- daily ---
    "daily_fact": "SELECT * FROM fact",
    "daily_flags": "SELECT * FROM flags",
    "user_summary": """
        SELECT user_id, count(*) AS total_days, CAST(sum(met_steps_goal) AS BIGINT) AS steps_goal_days,
               CAST(sum(met_activity_goal) AS BIGINT) AS activity_goal_days,
               round(sum(met_steps_goal) / count(*) * 100, 1) AS steps_compliance_pct
        FROM flags GROUP BY user_id""",
    "engagement_7d": f"""
        SELECT user_id, activity_date, is_engaged_day, CAST(e AS BIGINT) AS engaged_days_last_7,
               round(e / 7, 2) AS engagement_ratio_7d
        FROM (SELECT *, sum(is_engaged_day) {_LAST_7} AS e FROM flags)""",
    "steps_delta": f"""
        SELECT user_id, activity_date, daily_steps, y AS yesterday_steps, daily_steps - y AS delta_steps_vs_yesterday,
               CASE WHEN daily_steps > y THEN 1 ELSE 0 END AS steps_improved_vs_yesterday
        FROM (SELECT *, lag(daily_steps) {_BY_DAY} AS y FROM fact)""",
    "activity_trend": f"""
        SELECT user_id, activity_date, daily_active_minutes, active_minutes_7d, active_minutes_7d_prev,
               active_minutes_7d - active_minutes_7d_prev AS delta_active_minutes_7d,
               CASE WHEN active_minutes_7d > active_minutes_7d_prev THEN 'IMPROVING'
                    WHEN active_minutes_7d < active_minutes_7d_prev THEN 'DECLINING' ELSE 'STABLE' END AS activity_trend_7d
        FROM (SELECT *, lag(active_minutes_7d, 7) {_BY_DAY} AS active_minutes_7d_prev
              FROM (SELECT *, VeryActiveMinutes + FairlyActiveMinutes AS daily_active_minutes,
                           CAST(sum(VeryActiveMinutes + FairlyActiveMinutes) {_LAST_7} AS BIGINT) AS active_minutes_7d
                    FROM fact))""",
    "activity_variance_7d": f"""
        SELECT user_id, activity_date, round(var_samp(VeryActiveMinutes) {_LAST_7}, 6) AS activity_variance_7d FROM fact""",
    "active_streaks": """
        SELECT user_id, n - n_engaged AS active_group, count(*) AS activity_day_streak, min(activity_date) AS first_date,
               max(activity_date) AS last_date
        FROM numbered WHERE is_engaged_day = 1 GROUP BY user_id, n - n_engaged""",
    "active_streaks_by_date": """
        SELECT user_id, count(*) AS activity_day_streak, min(activity_date) AS first_date, max(activity_date) AS last_date
        FROM numbered WHERE is_engaged_day = 1
        GROUP BY user_id, date_diff('day', DATE '1970-01-01', activity_date) - n_engaged""",
    "sedentary_streaks": """
        SELECT user_id, n - n_sedentary AS sedentary_group, count(*) AS sedentary_day_streak,
               min(activity_date) AS first_date, max(activity_date) AS last_date
        FROM numbered WHERE low_sedentary = 0 GROUP BY user_id, n - n_sedentary""",
    "reward_eligibility": f"""
        SELECT user_id, activity_date, active_days_7d, CAST(a AS INTEGER) AS activity_day_streak,
               CAST(s AS INTEGER) AS sedentary_day_streak,
               CASE WHEN active_days_7d >= 5 AND a >= 3 AND s < 4 THEN 1 ELSE 0 END AS reward_eligible
        FROM (SELECT user_id, activity_date, CAST(sum(is_engaged_day) {_LAST_7} AS BIGINT) AS active_days_7d,
                     CASE WHEN is_engaged_day = 1 THEN row_number() OVER
                          (PARTITION BY user_id, is_engaged_day, n - n_engaged ORDER BY activity_date) ELSE 0 END AS a,
                     CASE WHEN low_sedentary = 0 THEN row_number() OVER
                          (PARTITION BY user_id, low_sedentary, n - n_sedentary ORDER BY activity_date) ELSE 0 END AS s
              FROM numbered)""",
    "peak_hour": "SELECT * FROM peak",
    "hourly_features": """
        SELECT Id, activity_date, active_hours, avg_steps_per_hour, peak_activity_hour
        FROM (SELECT Id, activity_date, CAST(sum(is_active_hour) AS BIGINT) AS active_hours,
                     avg(StepTotal) AS avg_steps_per_hour FROM hourly GROUP BY Id, activity_date)
        LEFT JOIN peak USING (Id, activity_date)""",
    "feature_store": f"""
        SELECT user_id, activity_date, total_steps, total_calories, sleep_minutes,
               round(avg(total_steps) {_LAST_7}, 6) AS steps_7day_avg,
               round(stddev_samp(total_steps) {_LAST_7}, 6) AS steps_7day_std,
               round(avg(total_calories) OVER (PARTITION BY user_id), 6) AS calories_avg,
               round(avg(sleep_minutes) OVER (PARTITION BY user_id), 6) AS sleep_avg,
               CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY activity_date) AS INTEGER) AS same_steps_streak
        FROM (SELECT *, sum(CASE WHEN total_steps IS NOT DISTINCT FROM before AND n > 1 THEN 0 ELSE 1 END) {_BY_DAY} AS run
              FROM (SELECT *, lag(total_steps) {_BY_DAY} AS before, row_number() {_BY_DAY} AS n
                    FROM (SELECT *, make_date(year, month, day) AS activity_date FROM gold_full)))""",
    "feature_store_asof": f"""
        SELECT user_id, activity_date, total_steps, total_calories, sleep_minutes,
               round(avg(total_steps) {_LAST_7}, 6) AS steps_7day_avg,
               round(stddev_samp(total_steps) {_LAST_7}, 6) AS steps_7day_std,
               round(avg(total_calories) {_BY_DAY}, 6) AS calories_avg,
               round(avg(sleep_minutes) {_BY_DAY}, 6) AS sleep_avg,
               CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY activity_date) AS INTEGER) AS same_steps_streak
        FROM (SELECT *, sum(CASE WHEN total_steps IS NOT DISTINCT FROM before AND n > 1 THEN 0 ELSE 1 END) {_BY_DAY} AS run
              FROM (SELECT *, lag(total_steps) {_BY_DAY} AS before, row_number() {_BY_DAY} AS n
                    FROM (SELECT * REPLACE (CASE WHEN day % 3 = 1 AND anomaly_score > 0.1 THEN total_steps + 7 ELSE total_steps END AS total_steps),
                                 make_date(year, month, day) AS activity_date FROM gold_full)))""",
    "feature_asof_join": f"""
        SELECT e.user_id, e.activity_date, e.event_type, f.feature_date AS feature_date_as_of, f.steps_7day_avg
        FROM found e ASOF LEFT JOIN (
            SELECT user_id, activity_date AS feature_date, round(steps_7day_avg, 6) AS steps_7day_avg
            FROM (SELECT user_id, activity_date, avg(total_steps) {_LAST_7} AS steps_7day_avg, total_steps, lag(total_steps) {_BY_DAY} AS before, row_number() {_BY_DAY} AS n
                  FROM (SELECT *, make_date(year, month, day) AS activity_date FROM gold_full))
            WHERE n = 1 OR total_steps IS DISTINCT FROM before) f
        ON e.user_id = f.user_id AND e.activity_date > f.feature_date""",
    # --- events ---
    "detect_events": "SELECT * FROM found",
    "event_messages": f"SELECT user_id, {_message()} AS body FROM found",
    "reward_decode": "SELECT * FROM decoded",
    "event_routing": """
        SELECT user_id, activity_date, event_type,
               CASE WHEN failed THEN 'failed' WHEN event_type = 'WORKOUT_COMPLETED' THEN 'reward'
                    WHEN event_type = 'INACTIVITY_DETECTED' THEN 'remind' WHEN event_type = 'FRAUD_DETECTED' THEN 'skip'
                    ELSE 'log' END AS route
        FROM decoded""",
    "event_counts": f"""
        SELECT 'ingest' AS step, CASE WHEN errors = '' THEN 'valid' ELSE 'invalid' END AS outcome, count(*) AS row_count
        FROM (SELECT {_ERRORS} AS errors FROM raw) GROUP BY ALL
        UNION ALL SELECT 'detect', 'sent', count(*) FROM found
        UNION ALL SELECT 'detect', 'skipped', (SELECT count(*) FROM gold_full) - (SELECT count(*) FROM found)
        UNION ALL SELECT 'detect', 'unreadable', 0
        UNION ALL SELECT 'reward', CASE WHEN failed THEN 'failed' ELSE 'processed' END, count(*) FROM decoded GROUP BY ALL""",
    "reward_state": "SELECT * FROM state",
    "badge_unlocks": "SELECT * FROM unlocks",
    "notifications": """
        SELECT user_id, activity_date, 'fraud' AS kind, '🚨 Fraud Detected!' AS subject,
               'User: ' || user_id || chr(10) || 'Day: ' || day || chr(10) || message AS body
        FROM found WHERE event_type = 'FRAUD_DETECTED'
        UNION ALL
        SELECT user_id, activity_date, 'reminder', 'Daily Activity Reminder 🏃',
               'Hey ' || user_id || '!' || chr(10) || 'No steps recorded on day ' || day || chr(10)
               || 'Time to get moving! 💪' || chr(10) || 'Even a short walk counts!'
        FROM found WHERE event_type = 'INACTIVITY_DETECTED'
        UNION ALL
        SELECT p.user_id, p.activity_date, 'reward', 'Workout Reward Earned! 💪',
               'Great job ' || p.user_id || '!' || chr(10) || '+' || points || ' points earned today' || chr(10)
               || 'Total points: ' || p.running_points || chr(10) || 'Total workouts: ' || workout_number
               || CASE WHEN u.badges IS NULL THEN '' ELSE chr(10) || '🏅 New badge unlocked: ' || u.badges || '!' END
        FROM progress p LEFT JOIN (SELECT user_id, activity_date, string_agg(badge, ', ' ORDER BY threshold) AS badges
                                   FROM unlocks GROUP BY user_id, activity_date) u USING (user_id, activity_date)""",
    # --- reports ---
    "leaderboard": "SELECT user_id, total_points, badges, workout_count, last_day FROM state ORDER BY total_points DESC, user_id",
    "top_users": """
        SELECT user_id, CAST(sum(total_steps) AS BIGINT) AS total_steps FROM gold_full GROUP BY user_id
        ORDER BY total_steps DESC, user_id LIMIT 5""",
    "user_profile": """
        SELECT g.user_id, days, total_steps, best_day_steps, active_minutes, sleep_minutes, suspicious_days,
               coalesce(total_points, 0) AS total_points, coalesce(badges, '') AS badges,
               coalesce(workout_count, 0) AS workout_count, last_day
        FROM (SELECT user_id, count(*) AS days, CAST(sum(total_steps) AS BIGINT) AS total_steps,
                     max(total_steps) AS best_day_steps, CAST(sum(active_minutes) AS BIGINT) AS active_minutes,
                     CAST(sum(sleep_minutes) AS BIGINT) AS sleep_minutes, count(*) FILTER (WHERE anomaly_score >= 0.8) AS suspicious_days
              FROM gold_full GROUP BY user_id) g LEFT JOIN state s USING (user_id)""",
    "sedentary_share": """
        SELECT count(*) AS users, count(*) FILTER (WHERE mean < 1000) AS sedentary_users,
               round(avg(CASE WHEN mean < 1000 THEN 1 ELSE 0 END) * 100, 2) AS sedentary_users_pct,
               CAST(sum(days) AS BIGINT) AS days, CAST(sum(idle) AS BIGINT) AS sedentary_days,
               round(sum(idle) / sum(days) * 100, 2) AS sedentary_days_pct
        FROM (SELECT avg(total_steps) AS mean, count(*) AS days, count(*) FILTER (WHERE activity_level = 'SEDENTARY') AS idle
              FROM gold_full GROUP BY user_id)""",
    "fraud_explain": """
        SELECT user_id, make_date(year, month, day) AS activity_date, total_steps, total_steps - 15000 AS steps_over_limit,
               active_minutes, max_steps_in_minute, anomaly_score, 'Steps exceed daily maximum' AS fraud_reason
        FROM gold_full WHERE anomaly_score >= 0.8""",
    "adhoc_sql": ADHOC.replace("daily_summary", "gold_full"),
    "retention_report": "SELECT * FROM retention",
    "retention_savings": """
        SELECT CAST(sum(deleted_files) AS BIGINT) AS total_deleted, round(sum(bytes_freed) / 1024 / 1024 / 1024, 2) AS gb_freed,
               round(sum(bytes_freed) / 1024 / 1024 / 1024 * 0.023, 2) AS monthly_savings FROM retention""",
    "retention_filter": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
        WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') <= 365""",
    # --- change data ---
    "cdc_apply": "SELECT * FROM applied",
    "snapshot_diff": f"""
        SELECT user_id, timestamp, {_VALUES}, 'insert' AS _change_type
        FROM applied n ANTI JOIN base USING (user_id, timestamp)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, 'delete' FROM base o ANTI JOIN applied USING (user_id, timestamp)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, 'update_preimage' FROM (
            SELECT o.* FROM base o JOIN applied n USING (user_id, timestamp) WHERE o.seq <> n.seq)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, 'update_postimage' FROM (
            SELECT n.* FROM base o JOIN applied n USING (user_id, timestamp) WHERE o.seq <> n.seq)""",
    "gold_incremental": _gold("applied"),
    "feed_between_versions": f"""
        SELECT user_id, timestamp, {_VALUES}, CAST(NULL AS INTEGER) AS heart_rate, 'insert' AS _change_type, 1 AS since
        FROM applied n ANTI JOIN base USING (user_id, timestamp)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, NULL, 'delete', 1 FROM base o ANTI JOIN applied USING (user_id, timestamp)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, NULL, 'update_preimage', 1 FROM (
            SELECT o.* FROM base o JOIN applied n USING (user_id, timestamp) WHERE o.seq <> n.seq)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, NULL, 'update_postimage', 1 FROM (
            SELECT n.* FROM base o JOIN applied n USING (user_id, timestamp) WHERE o.seq <> n.seq)
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, NULL, 'update_preimage', 2 FROM applied WHERE sleep_value = 1
        UNION ALL
        SELECT user_id, timestamp, {_VALUES}, 60 + intensity, 'update_postimage', 2
        FROM (SELECT * REPLACE (seq + 10 AS seq) FROM applied) WHERE sleep_value = 1""",
    "gold_partials": _gold("applied"),
    "gold_followed": f"""
        SELECT *, CASE WHEN insurance_risk_score <= 10 THEN 'DISCOUNT_10%' WHEN insurance_risk_score >= 90 THEN 'SURCHARGE_20%'
                       ELSE 'STANDARD' END AS premium_adjustment
        FROM (SELECT {_FRAUD_FLAGS}, CASE activity_level WHEN 'HIGH' THEN 10 WHEN 'MEDIUM' THEN 30 WHEN 'LOW' THEN 60
                     ELSE 90 END AS insurance_risk_score FROM gold_applied)""",
    "gold_expectations": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS total_rows, count(*) FILTER (WHERE ({test}) IS NOT TRUE) AS failed_rows FROM gold_from_silver"
        for name, test in (("valid_total_steps", "total_steps >= 0"), ("valid_total_calories", "total_calories >= 0"), ("valid_user_id", "user_id IS NOT NULL"),
                           ("valid_anomaly_score", "anomaly_score BETWEEN 0 AND 1"), ("valid_fraud_flag", "true"))
    ),
    # --- model ---
    "training_set": """
        SELECT CASE WHEN anomaly_score >= 0.8 THEN 1 ELSE 0 END AS label, total_steps, total_calories, active_minutes,
               sleep_minutes, avg_intensity, max_steps_in_minute, user_id, date,
               CASE WHEN CAST('0x' || substr(sha256('42|' || user_id || '|' || date), 1, 8) AS BIGINT) < floor(0.8 * 4294967296)
                    THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, CAST(year AS VARCHAR) || '-' || month || '-' || day AS date FROM gold_full)""",
    "label_distribution": """
        SELECT CASE WHEN anomaly_score >= 0.8 THEN 1 ELSE 0 END AS label, count(*) AS row_count FROM gold_full GROUP BY ALL""",
    "decode_prediction": """
        SELECT user_id, date, CAST(raw_prediction AS DOUBLE) AS raw_prediction, rounded_level, exact_level,
               CASE WHEN raw_prediction >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_class
        FROM decoded_codes""",
    "predictions_written": """
        SELECT d.user_id, d.date, g.total_steps, g.total_calories, CASE WHEN raw_prediction >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS predicted_class,
               CAST(raw_prediction AS DOUBLE) AS raw_prediction, d.anomaly_score, 'v1' AS model_version
        FROM decoded_codes d JOIN (SELECT *, CAST(year AS VARCHAR) || '-' || month || '-' || day AS date FROM gold_full) g
          ON d.user_id = g.user_id AND d.date = g.date""",
    "prediction_classes": """
        SELECT CASE WHEN raw_prediction >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS predicted_class, count(*) AS row_count,
               count(*) FILTER (WHERE anomaly_score >= 0.8) AS fraud_rows
        FROM decoded_codes GROUP BY ALL
        UNION ALL SELECT 'TOTAL', count(*), count(*) FILTER (WHERE anomaly_score >= 0.8) FROM decoded_codes""",
    "prediction_report": """
        SELECT rounded_level AS predicted_activity, count(*) AS row_count, count(*) FILTER (WHERE anomaly_score >= 0.8) AS fraud_rows
        FROM decoded_codes GROUP BY rounded_level
        UNION ALL SELECT 'TOTAL', count(*), count(*) FILTER (WHERE anomaly_score >= 0.8) FROM decoded_codes""",
}


#: What is written and read back equals what went in.
_BODIES |= {
    "csv_daily_fact": """
        SELECT user_id, activity_date, CAST(daily_calories AS INTEGER) AS daily_calories, CAST(daily_steps AS INTEGER) AS daily_steps,
               CAST(SedentaryMinutes AS INTEGER) AS SedentaryMinutes, CAST(LightlyActiveMinutes AS INTEGER) AS LightlyActiveMinutes,
               CAST(FairlyActiveMinutes AS INTEGER) AS FairlyActiveMinutes, CAST(VeryActiveMinutes AS INTEGER) AS VeryActiveMinutes
        FROM fact""",
    "csv_hourly_features": _BODIES["hourly_features"],
    "csv_minute_merge": _BODIES["minute_merge"],
    "json_bronze": _BODIES["silver_typed"],
    "event_lines": _gold("scaled_silver"),
    "event_lines_refused": "SELECT user_id, count(*) AS row_count FROM gold_full WHERE day = 2 GROUP BY ALL",
    "predictions_files": f"""
        SELECT * EXCLUDE (model_version), (SELECT count(*) FROM gold_full) AS total_users FROM ({_BODIES["predictions_written"]})""",
    "training_csv": f"SELECT * EXCLUDE (user_id, date) FROM ({_BODIES['training_set']})",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name, part in _PARTS.items():
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+\(?{name}\b", text):
            _needed(part, found)
            found[name] = None


def statement(body: str) -> str:
    found: dict[str, None] = {}
    _needed(body, found)
    parts = ",\n".join(f"{name} AS ({_PARTS[name]})" for name in found)
    return f"WITH {parts}\n{body}" if parts else body


def statements() -> dict[str, str]:
    return {name: statement(body) for name, body in _BODIES.items()}
