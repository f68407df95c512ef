"""Streaming transformations. Stateless ones are the batch functions themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stridelake.config import DEFAULTS, Thresholds
from stridelake.operators import gold as G
from stridelake.operators import rules as R
from stridelake.operators import silver as S

OBSERVED = "expectations"


EVENT_TIME = "_event_time"


def _event_time(df: DataFrame, watermark: str) -> DataFrame:
    """Watermarks need a zoned time; with the session in UTC it is the same instant."""
    return df.withColumn(EVENT_TIME, F.col("timestamp").cast("timestamp")).withWatermark(EVENT_TIME, watermark)


def silver_stream(raw: DataFrame, preset: str | Sequence[R.Rule] = "stream", watermark: str | None = None,
                  t: Thresholds = DEFAULTS, hex_chars: int = 8) -> DataFrame:
    """Raw stream to silver rows.

    ``user_key`` is the whole digest of the id: the sinks merge on it, so people whose short masks agree keep their rows.
    What is summed by ``user_id`` still adds them up; ``hex_chars`` of 16 or more keeps large populations apart there too.

    With ``watermark``, copies of a (user, minute) are dropped on the way; state is kept for that
    long in event time only, and rows later than it are dropped too. Without, the table sink removes
    copies by key, however late they come, and the stream holds no state. Rows without user or time
    are filtered first: they would all share one key.
    """
    rules = R.PRESETS[preset] if isinstance(preset, str) else preset
    typed = R.observe_rules(S.typed(raw), rules, OBSERVED)
    rows = R.enforce(typed, rules).filter(F.col("timestamp").isNotNull() & F.expr(R.HAS_USER))
    if watermark is not None:
        rows = _event_time(rows, watermark).dropDuplicatesWithinWatermark(list(S.KEYS)).drop(EVENT_TIME)
    return finished(rows, t, hex_chars)


def finished(rows: DataFrame, t: Thresholds = DEFAULTS, hex_chars: int = 8) -> DataFrame:
    """Trusted typed rows as silver stores them: whole digest and short mask of the user, date parts, flags, audit time."""
    keyed = rows.withColumn(S.USER_KEY, F.sha2(F.col("user_id").cast("string"), 256))
    return S.stamp(S.enrich(S.mask(keyed, hex_chars), t))


def observed_totals(query: StreamingQuery, name: str = OBSERVED) -> dict[str, int]:
    """Violation counts summed over the recent batches Spark lists, a live view. ``tables.counted`` keeps them all."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = (progress.observedMetrics or {}).get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            totals[key] = totals.get(key, 0) + value
    return totals


def day_totals_stream(silver: DataFrame, full: bool = True, t: Thresholds = DEFAULTS) -> DataFrame:
    """Running daily summary for update mode and an upsert sink. State holds every user-day seen."""
    return G.classify(G.day_totals(silver), full, t)


def closed_days_stream(silver: DataFrame, watermark: str = "2 days", full: bool = True,
                       t: Thresholds = DEFAULTS) -> DataFrame:
    """Daily summary for append mode: a day is emitted once the watermark has passed it, then forgotten."""
    totals = (
        _event_time(silver, watermark)
        .groupBy("user_id", F.window(EVENT_TIME, "1 day").alias("w"))
        .agg(*G.day_aggregates())
        .select(
            "user_id",
            F.year("w.start").alias("year"),
            F.month("w.start").alias("month"),
            F.dayofmonth("w.start").alias("day"),
            *["total_steps", "total_calories", "active_minutes", "sleep_minutes", "avg_intensity",
              "max_steps_in_minute", "total_minutes_recorded"],
        )
    )
    return G.classify(totals, full, t)
