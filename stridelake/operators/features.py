"""Daily and hourly features.

All windows run per user over rows of one user-day each. The number of rows of a user is therefore
bounded by the days in the table, not by the volume of minute data, which has been summed before.
Every operator that needs several window columns uses the same partitioning and order, so Spark
shuffles and sorts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, Thresholds
from stridelake.functions import columns as X


def by_day() -> WindowSpec:
    return Window.partitionBy("user_id").orderBy("activity_date")


def last_7() -> WindowSpec:
    return by_day().rowsBetween(-6, 0)


def so_far() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, 0)


# --- daily table ---


def daily_fact(calories: DataFrame, steps: DataFrame, intensities: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Three daily tables joined on user and day."""
    day = X.parse_date(F.col("ActivityDay")).alias("activity_date")
    keys = ["user_id", "activity_date"]
    user = F.col("Id").alias("user_id")
    left = calories.select(user, day, F.col("Calories").alias("daily_calories"))
    mid = steps.select(user, day, F.col("StepTotal").alias("daily_steps"))
    right = intensities.select(
        user, day, "SedentaryMinutes", "LightlyActiveMinutes", "FairlyActiveMinutes", "VeryActiveMinutes"
    )
    return left.join(mid, keys, "inner").join(right, keys, "inner")


def daily_flags(fact: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Goal flags and the engaged-day flag, which is also the daily activity flag."""
    return fact.withColumns(
        {
            "met_steps_goal": X.flag(F.col("daily_steps") >= t.steps_goal),
            "met_activity_goal": X.flag(F.col("VeryActiveMinutes") >= t.very_active_goal),
            "low_sedentary": X.flag(F.col("SedentaryMinutes") <= t.sedentary_limit),
        }
    ).withColumn("is_engaged_day", X.flag((F.col("met_steps_goal") == 1) | (F.col("met_activity_goal") == 1)))


def user_summary(flags: DataFrame) -> DataFrame:
    return (
        flags.groupBy("user_id")
        .agg(
            F.count("activity_date").alias("total_days"),
            F.sum("met_steps_goal").alias("steps_goal_days"),
            F.sum("met_activity_goal").alias("activity_goal_days"),
        )
        .withColumn(
            "steps_compliance_pct",
            F.round(F.try_divide(F.col("steps_goal_days"), F.col("total_days")) * 100, 1),
        )
    )


# --- seven-row windows and lags ---


def engagement_7d(flags: DataFrame) -> DataFrame:
    """Engaged days in the last 7 rows and their share of 7."""
    return flags.withColumn("engaged_days_last_7", F.sum("is_engaged_day").over(last_7())).withColumn(
        "engagement_ratio_7d", F.round(F.col("engaged_days_last_7") / 7, 2)
    )


def steps_delta(fact: DataFrame) -> DataFrame:
    """Change against the previous row of the user."""
    return (
        fact.withColumn("yesterday_steps", F.lag("daily_steps", 1).over(by_day()))
        .withColumn("delta_steps_vs_yesterday", F.col("daily_steps") - F.col("yesterday_steps"))
        .withColumn("steps_improved_vs_yesterday", X.flag(F.col("delta_steps_vs_yesterday") > 0))
    )


def activity_trend(fact: DataFrame) -> DataFrame:
    """Active minutes of the last 7 rows against the 7 rows before."""
    return (
        fact.withColumn("daily_active_minutes", F.col("VeryActiveMinutes") + F.col("FairlyActiveMinutes"))
        .withColumn("active_minutes_7d", F.sum("daily_active_minutes").over(last_7()))
        .withColumn("active_minutes_7d_prev", F.lag("active_minutes_7d", 7).over(by_day()))
        .withColumn("delta_active_minutes_7d", F.col("active_minutes_7d") - F.col("active_minutes_7d_prev"))
        .withColumn("activity_trend_7d", X.trend(F.col("delta_active_minutes_7d")))
    )


def activity_variance_7d(fact: DataFrame) -> DataFrame:
    """Sample variance of the very active minutes over the last 7 rows; NULL for a single row."""
    return fact.withColumn("activity_variance_7d", F.var_samp("VeryActiveMinutes").over(last_7()))


# --- streaks ---


def _position(by: str) -> Column:
    """What must advance by one inside a streak: the row number, or the calendar day."""
    if by == "row":
        return F.row_number().over(by_day())
    if by == "date":
        return F.datediff("activity_date", F.lit("1970-01-01").cast("date"))
    raise ValueError(f"by must be 'row' or 'date', not {by!r}")


def streaks(fact: DataFrame, flag: str, on_value: int = 1, by: str = "row") -> DataFrame:
    """Length of every run of days whose flag has ``on_value``.

    Inside a run, position and the running count of such days grow together, so their difference
    names the run. The count runs over the same window as the position: one shuffle, one sort.
    """
    on = F.col(flag) == on_value
    return (
        fact.withColumn("streak_group", _position(by) - F.sum(X.flag(on)).over(so_far()))
        .filter(on)
        .groupBy("user_id", "streak_group")
        .agg(
            F.count(F.lit(1)).alias("streak_days"),
            F.min("activity_date").alias("first_date"),
            F.max("activity_date").alias("last_date"),
        )
    )


def current_streak(fact: DataFrame, flag: str, name: str, on_value: int = 1, by: str = "row") -> DataFrame:
    """Per day, how many days the run has lasted up to and including it; 0 when the flag is off."""
    on = F.col(flag) == on_value
    broken = X.flag(on) != F.coalesce(F.lag(X.flag(on)).over(by_day()), F.lit(0))
    if by == "date":
        broken = broken | (F.datediff("activity_date", F.lag("activity_date").over(by_day())) > 1)
    elif by != "row":
        raise ValueError(f"by must be 'row' or 'date', not {by!r}")
    return (
        fact.withColumn("_row", F.row_number().over(by_day()))
        .withColumn("_start", F.when(broken, F.col("_row")))
        .withColumn("_start", F.max("_start").over(so_far()))
        .withColumn(name, F.when(on, F.col("_row") - F.col("_start") + 1).otherwise(0))
        .drop("_row", "_start")
    )


def reward_eligibility(flags: DataFrame, t: Thresholds = DEFAULTS, by: str = "row") -> DataFrame:
    """Engaged enough this week, on a running streak, and not sitting for days."""
    df = engagement_7d(flags).withColumnRenamed("engaged_days_last_7", "active_days_7d")
    df = current_streak(df, "is_engaged_day", "activity_day_streak", 1, by)
    df = current_streak(df, "low_sedentary", "sedentary_day_streak", 0, by)
    return df.withColumn(
        "reward_eligible",
        X.flag(
            (F.col("active_days_7d") >= t.eligible_active_days)
            & (F.col("activity_day_streak") >= t.eligible_active_streak)
            & (F.col("sedentary_day_streak") < t.eligible_sedentary_below)
        ),
    )


# --- hourly table ---


def _with_hour(df: DataFrame, measure: str) -> DataFrame:
    ts = X.parse_ts(F.col("ActivityHour"))
    return df.select("Id", ts.alias("ActivityHour_ts"), measure)


def hourly_fact(steps: DataFrame, intensities: DataFrame) -> DataFrame:
    """Hourly steps and intensities. Date and hour follow from the time, so that is the join key."""
    return (
        _with_hour(steps, "StepTotal")
        .join(_with_hour(intensities, "TotalIntensity"), ["Id", "ActivityHour_ts"], "inner")
        .withColumns(
            {
                "activity_date": F.to_date("ActivityHour_ts"),
                "activity_hour": F.hour("ActivityHour_ts"),
                "is_active_hour": X.flag((F.col("StepTotal") > 0) | (F.col("TotalIntensity") > 0)),
            }
        )
    )


def peak_hour(hourly: DataFrame) -> DataFrame:
    """Hour with the most steps per user and day, the earliest one on a tie."""
    best = Window.partitionBy("Id", "activity_date").orderBy(F.col("StepTotal").desc(), "activity_hour")
    return (
        hourly.withColumn("_rn", F.row_number().over(best))
        .filter("_rn = 1")
        .select("Id", "activity_date", F.col("activity_hour").alias("peak_activity_hour"))
    )


def hourly_features(hourly: DataFrame) -> DataFrame:
    """Active hours, mean steps and peak hour per user and day.

    Steps and hour are packed into one integer whose maximum is the peak (missing steps rank last,
    early hours rank higher), so one hash aggregate answers all three without a join back.
    """
    no_steps = F.lit(-(2**50))
    rank = F.coalesce(F.col("StepTotal").cast("bigint"), no_steps) * 24 + (23 - F.col("activity_hour"))
    return (
        hourly.groupBy("Id", "activity_date")
        .agg(
            F.sum("is_active_hour").alias("active_hours"),
            F.avg("StepTotal").alias("avg_steps_per_hour"),
            F.max(rank).alias("_peak"),
        )
        .withColumn("peak_activity_hour", (23 - F.pmod(F.col("_peak"), F.lit(24))).cast("int"))
        .drop("_peak")
    )


# --- feature store ---


def feature_store(gold: DataFrame) -> DataFrame:
    """Model features per user-day: 7-row step mean and deviation, user means, run of equal step counts."""
    whole = Window.partitionBy("user_id")
    changed = ~F.col("total_steps").eqNullSafe(F.lag("total_steps").over(by_day()))
    return (
        gold.select("user_id", F.make_date("year", "month", "day").alias("activity_date"),
                    "total_steps", "total_calories", "sleep_minutes")
        .withColumns(
            {
                "steps_7day_avg": F.avg("total_steps").over(last_7()),
                "steps_7day_std": F.stddev_samp("total_steps").over(last_7()),
                "calories_avg": F.avg("total_calories").over(whole),
                "sleep_avg": F.avg("sleep_minutes").over(whole),
                "_row": F.row_number().over(by_day()),
            }
        )
        .withColumn("_start", F.when((F.col("_row") == 1) | changed, F.col("_row")))
        .withColumn("same_steps_streak", F.col("_row") - F.max("_start").over(so_far()) + 1)
        .drop("_row", "_start")
    )


# --- features as of a day, from what is carried over ---

#: Rows of a user that a 7-row window reaches back to.
REACH = 6
FEATURE_STATE = (
    "user_id string, last_rows array<struct<activity_date:date,total_steps:bigint>>, calories_sum double, calories_n bigint, "
    "sleep_sum bigint, sleep_n bigint, same_steps_streak int"
)


def feature_days(gold: DataFrame) -> DataFrame:
    """The columns of the daily table that the features are made of."""
    return gold.select("user_id", F.make_date("year", "month", "day").alias("activity_date"), "total_steps", "total_calories", "sleep_minutes")


def features_as_of(days: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features of ``days``, state after them). A day's features use that day and earlier ones, never a later one.

    ``state`` holds one line for each user: the last six rows, sums and counts behind the means, and the run of equal step
    counts. It must end before the user's first new day. A user's window group is those six rows and the new days, however
    long the history; users without new days are not in the result, their lines stay as they are.
    """
    carried = ("calories_sum", "calories_n", "sleep_sum", "sleep_n", "same_steps_streak")
    own = state.join(days.select("user_id").distinct(), "user_id", "left_semi")
    old = own.select("user_id", F.explode("last_rows").alias("_r")).select("user_id", "_r.*", F.lit(False).alias("_new"))
    rows = old.unionByName(days.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    rows = rows.join(own.select("user_id", *[F.col(c).alias(f"_{c}") for c in carried]), "user_id", "left")
    steps, new = F.col("total_steps"), F.col("_new")
    changed = ~steps.eqNullSafe(F.lag(steps).over(by_day()))

    def so_far_of(c: str, name: str, kind: str) -> dict[str, Column]:
        value = F.when(new, F.col(c))
        return {
            f"{name}_sum": (F.coalesce(f"_{name}_sum", F.lit(0)) + F.coalesce(F.sum(value).over(so_far()), F.lit(0))).cast(kind),
            f"{name}_n": F.coalesce(f"_{name}_n", F.lit(0)) + F.count(value).over(so_far()),
        }

    rows = rows.withColumns(
        {
            "steps_7day_avg": F.avg(steps).over(last_7()),
            "steps_7day_std": F.stddev_samp(steps).over(last_7()),
            **so_far_of("total_calories", "calories", "double"),
            **so_far_of("sleep_minutes", "sleep", "bigint"),
            "_nth": F.sum(X.flag(new)).over(so_far()),
            "_first": F.row_number().over(by_day()) == 1,
            "_changed": changed,
        }
    )
    start = F.max(F.when(new & (F.col("_first") | F.col("_changed")), F.col("_nth"))).over(so_far())
    run = F.when(start.isNull(), F.coalesce("_same_steps_streak", F.lit(0)) + F.col("_nth")).otherwise(F.col("_nth") - start + 1)
    rows = rows.withColumn("same_steps_streak", run.cast("int"))
    features = rows.filter("_new").select(
        "user_id", "activity_date", "total_steps", "total_calories", "sleep_minutes", "steps_7day_avg", "steps_7day_std",
        F.try_divide("calories_sum", "calories_n").alias("calories_avg"), F.try_divide("sleep_sum", "sleep_n").alias("sleep_avg"),
        "same_steps_streak")
    latest = F.max_by(F.struct(*carried), "activity_date").alias("_l")
    held = F.when(F.size("_all") > REACH, F.slice("_all", -REACH, REACH)).otherwise(F.col("_all"))
    lists = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("activity_date", "total_steps"))).alias("_all"), latest)
    return features, lists.select("user_id", held.alias("last_rows"), "_l.*")


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, strict: bool = False) -> DataFrame:
    """Each row of ``left`` with the columns of the newest row of ``right`` up to its time (before it, if ``strict``).

    Both sides are sorted together by key and time, and the newest right row is carried along: one shuffle and no pairs,
    however many rows a key has. Rows without a match keep NULLs; ``right`` has one row for each key and time.
    """
    values = [c for c in right.columns if c not in (*keys, right_time)]
    ours = left.select(*keys, F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_left"))
    theirs = right.select(*keys, F.col(right_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"),
                          F.struct(F.col(right_time).alias("_at"), *values).alias("_right"))
    both = ours.unionByName(theirs, allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_right", F.last("_right", ignorenulls=True).over(before)).filter(F.col("_left").isNotNull())
    return met.select("_left.*", F.col("_right._at").alias(f"{right_time}_as_of"), *[F.col(f"_right.{v}").alias(v) for v in values])
