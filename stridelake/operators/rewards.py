"""Points and badges. Totals do not change when a message is delivered again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.config import BADGES, WORKOUT
from stridelake.functions import columns as X


def _no_badges() -> Column:
    return F.array().cast("array<string>")


def workouts(messages: DataFrame) -> DataFrame:
    """One row per rewarded user-day. Copies of a message collapse before the shuffle."""
    kept = messages.filter(F.col("event_type") == WORKOUT)
    return kept.groupBy("user_id", "activity_date", "day").agg(F.max("points").alias("points"))


def earned_totals(messages: DataFrame) -> DataFrame:
    """Points, workouts and last day per user."""
    return workouts(messages).groupBy("user_id").agg(
        F.sum("points").alias("earned"),
        F.count(F.lit(1)).alias("done"),
        F.max("activity_date").alias("seen"),
        F.max("day").alias("seen_day"),
    )


def reward_state(messages: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Profile per user after ``messages``, on top of ``state`` if given.

    With a state, messages must be new to it (``streaming.tables.reward_sink`` does that bookkeeping).
    """
    earned = earned_totals(messages)
    if state is not None:
        return add_rewards(earned.join(state, "user_id", "full"))
    return add_rewards(
        earned.withColumns(
            {
                "total_points": F.lit(0).cast("bigint"),
                "badges": _no_badges(),
                "workout_count": F.lit(0).cast("bigint"),
                "last_day": F.lit(None).cast("int"),
                "last_activity_date": F.lit(None).cast("date"),
            }
        )
    )


def add_rewards(joined: DataFrame, *carry: str) -> DataFrame:
    """New profile from old profile columns and those of ``earned_totals``; either side may be missing."""
    # The new total gets its own name first: inside the badge lambdas "total_points" would resolve to
    # the select's own output column instead of the old total.
    rows = joined.withColumns(
        {
            "_total": F.coalesce("total_points", F.lit(0)) + F.coalesce("earned", F.lit(0)),
            "_held": F.coalesce("badges", _no_badges()),
        }
    )
    latest = F.greatest("seen", "last_activity_date")
    day = F.coalesce(F.dayofmonth(latest), F.col("seen_day"), F.col("last_day"))
    return rows.select(
        "user_id",
        F.col("_total").cast("bigint").alias("total_points"),
        F.concat("_held", X.new_badges(F.col("_total"), F.col("_held"))).alias("badges"),
        (F.coalesce("workout_count", F.lit(0)) + F.coalesce("done", F.lit(0))).cast("bigint").alias("workout_count"),
        day.cast("int").alias("last_day"),
        latest.alias("last_activity_date"),
        *carry,
    )


def workout_progress(messages: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per rewarded day: running points, workout number and the badges unlocked on it.

    Runs per user over rewarded days, at most one row per calendar day after ``workouts``.
    """
    so_far = Window.partitionBy("user_id").orderBy("activity_date", "day")
    rows = workouts(messages).withColumns(
        {
            "running_points": F.sum("points").over(so_far.rowsBetween(Window.unboundedPreceding, 0)),
            "workout_number": F.row_number().over(so_far).cast("bigint"),
        }
    )
    held = _no_badges()
    if state is not None:
        rows = rows.join(
            state.select("user_id", "total_points", "workout_count", F.col("badges").alias("_held")), "user_id", "left"
        ).withColumns(
            {
                "running_points": F.col("running_points") + F.coalesce("total_points", F.lit(0)),
                "workout_number": F.col("workout_number") + F.coalesce("workout_count", F.lit(0)),
            }
        )
        held = F.coalesce("_held", _no_badges())
    before = X.badges_for(F.col("running_points") - F.col("points"))
    return rows.withColumn(
        "new_badges", X.new_badges(F.col("running_points"), F.array_union(held, before))
    ).select("user_id", "activity_date", "day", "points", "running_points", "workout_number", "new_badges")


def badge_unlocks(progress: DataFrame) -> DataFrame:
    """One row per badge and user, on the day its threshold was reached."""
    limit = F.create_map(*[F.lit(v) for points, name in BADGES for v in (name, points)])
    return progress.select("user_id", "activity_date", "running_points", F.explode("new_badges").alias("badge")).select(
        "user_id", "activity_date", "running_points", "badge", limit[F.col("badge")].alias("threshold")
    )
