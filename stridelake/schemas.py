"""Table schemas, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "strings": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw minute events are kept as text; operators.silver.typed repairs the types.
BRONZE_RAW = _struct(
    "user_id string, timestamp string, steps string, calories string, intensity string, "
    "sleep_value string, event_type string, source string, ingest_time string"
)

DAILY_CALORIES = _struct("Id bigint, ActivityDay string, Calories int")
DAILY_STEPS = _struct("Id bigint, ActivityDay string, StepTotal int")
DAILY_INTENSITIES = _struct(
    "Id bigint, ActivityDay string, SedentaryMinutes int, LightlyActiveMinutes int, "
    "FairlyActiveMinutes int, VeryActiveMinutes int"
)
HOURLY_CALORIES = _struct("Id bigint, ActivityHour string, Calories int")
HOURLY_STEPS = _struct("Id bigint, ActivityHour string, StepTotal int")
HOURLY_INTENSITIES = _struct("Id bigint, ActivityHour string, TotalIntensity int")

MINUTE_STEPS = _struct("Id string, ActivityMinute string, Steps string")
MINUTE_CALORIES = _struct("Id string, ActivityMinute string, Calories string")
MINUTE_INTENSITIES = _struct("Id string, ActivityMinute string, Intensity string")
MINUTE_SLEEP = _struct("Id string, date string, value string, logId string")

GOLD_DAILY = _struct(
    "user_id string, year int, month int, day int, total_steps bigint, total_calories double, "
    "active_minutes bigint, sleep_minutes bigint, avg_intensity double, max_steps_in_minute int, "
    "total_minutes_recorded bigint, anomaly_score double, activity_level string"
)

MESSAGE = _struct(
    "user_id string, day int, activity_date date, event_type string, message string, "
    f"priority string, points int, timestamp string, {CORRUPT} string"
)

REWARD_STATE = _struct(
    "user_id string, total_points bigint, badges strings, workout_count bigint, "
    "last_day int, last_activity_date date"
)

WAREHOUSE_DDL = """
    user_id VARCHAR(50), year INT, month INT, day INT, total_steps BIGINT, total_calories DOUBLE,
    active_minutes BIGINT, sleep_minutes BIGINT, avg_intensity DOUBLE, max_steps_in_minute INT,
    total_minutes_recorded BIGINT, anomaly_score DOUBLE, activity_level VARCHAR(20), processed_at TIMESTAMP
"""
