"""Raw minute rows to trusted minute rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, Thresholds
from stridelake.functions import columns as X
from stridelake.operators import rules as R

KEYS = ("user_id", "timestamp")
#: Whole digest of the user's id, which stored tables merge on.
USER_KEY = "user_key"
MEASURES = ("steps", "calories", "intensity", "sleep_value")


def minute_merge(steps: DataFrame, calories: DataFrame, intensities: DataFrame, sleep: DataFrame) -> DataFrame:
    """Steps, calories and intensities of the same user and minute, with sleep where there is any.

    All four share the join key, so each input is shuffled once and the joins chain on it. Several
    sleep logs on one minute give several rows.
    """
    keys = ["Id", "ActivityMinute"]
    asleep = sleep.select("Id", F.col("date").alias("ActivityMinute"), F.col("value").alias("sleep_value"))
    return (
        steps.join(calories, keys, "inner")
        .join(intensities, keys, "inner")
        .join(asleep, keys, "left")
        .select(
            F.col("Id").alias("user_id"),
            F.col("ActivityMinute").alias("timestamp"),
            F.col("Steps").alias("steps"),
            F.col("Calories").alias("calories"),
            F.col("Intensity").alias("intensity"),
            "sleep_value",
        )
    )


def typed(df: DataFrame) -> DataFrame:
    """Repair the types of raw rows; a value that does not parse becomes NULL. Streams too."""
    return df.withColumns(
        {
            "steps": F.col("steps").try_cast("int"),
            "calories": F.col("calories").try_cast("double"),
            "intensity": F.col("intensity").try_cast("int"),
            "sleep_value": F.col("sleep_value").try_cast("int"),
            "timestamp": X.parse_ts(F.col("timestamp")),
        }
    )


def clean(df: DataFrame, preset: str | Sequence[R.Rule] = "batch") -> DataFrame:
    """Apply a rule preset to typed rows. Streams too."""
    return R.enforce(df, R.PRESETS[preset] if isinstance(preset, str) else preset)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order_by``.

    Spark turns "row_number = 1" into a group limit that also runs before the shuffle, so each task
    sends at most one row per key however many copies it holds.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def dedup(df: DataFrame, keys: Sequence[str] = KEYS, order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per user and minute: the latest arrival, ties broken by the measures."""
    if order_by is None:
        arrival = [F.col("ingest_time").desc()] if "ingest_time" in df.columns else []
        order_by = arrival + [F.col(c) for c in MEASURES if c in df.columns]
    return latest_per_key(df, keys, order_by)


def merge_keys(columns: Sequence[str]) -> list[str]:
    """What tells the rows of a stored silver table apart."""
    return [USER_KEY if c == "user_id" and USER_KEY in columns else c for c in KEYS]


def mask(df: DataFrame, hex_chars: int = 8) -> DataFrame:
    return df.withColumn("user_id", X.mask_user(F.col("user_id"), hex_chars))


def mask_collisions(df: DataFrame, hex_chars: int = 8) -> DataFrame:
    """Pseudonyms shared by several ids, with how many. Empty means the mask is still one to one."""
    return (
        df.select(F.col("user_id").cast("string").alias("id"), X.mask_user(F.col("user_id"), hex_chars).alias("masked"))
        .filter(F.col("masked").isNotNull())
        .distinct()
        .groupBy("masked")
        .agg(F.count(F.lit(1)).alias("ids"))
        .filter("ids > 1")
    )


def enrich(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Date parts and minute flags. Streams too."""
    ts = F.col("timestamp")
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour_of_day": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "is_active": X.is_active(F.col("steps"), t),
            "is_sleeping": X.is_sleeping(F.col("sleep_value")),
        }
    )


def build_silver(raw: DataFrame, preset: str | Sequence[R.Rule] = "batch", t: Thresholds = DEFAULTS,
                 hex_chars: int = 8) -> DataFrame:
    """Raw text rows to silver: repair, check, dedup on the raw id, mask, enrich."""
    return enrich(mask(dedup(clean(typed(raw), preset)), hex_chars), t)


def stamp(df: DataFrame) -> DataFrame:
    """Audit time of this run."""
    return df.withColumn("processed_at", F.current_timestamp())
