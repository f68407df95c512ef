"""Answers to the recurring questions, and free SQL over the tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, Thresholds
from stridelake.functions import columns as X


def leaderboard(state: DataFrame, n: int | None = None) -> DataFrame:
    """Profiles by points, best first. With ``n`` Spark keeps only the top n of each task."""
    board = state.withColumn("total_points", F.coalesce("total_points", F.lit(0))).orderBy(
        F.col("total_points").desc(), "user_id"
    )
    return board if n is None else board.limit(n)


def top_users(gold: DataFrame, n: int = 5) -> DataFrame:
    return (
        gold.groupBy("user_id")
        .agg(F.sum("total_steps").alias("total_steps"))
        .orderBy(F.col("total_steps").desc(), "user_id")
        .limit(n)
    )


def activity_profile(gold: DataFrame) -> DataFrame:
    """Activity of each user over all days."""
    return gold.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("total_steps").alias("total_steps"),
        F.max("total_steps").alias("best_day_steps"),
        F.sum("active_minutes").alias("active_minutes"),
        F.sum("sleep_minutes").alias("sleep_minutes"),
        F.count_if(X.is_fraud(F.col("anomaly_score"), DEFAULTS)).alias("suspicious_days"),
    )


def user_profile(gold: DataFrame, state: DataFrame, user_id: str | None = None) -> DataFrame:
    """Activity and rewards of one user, or of all. The id filter reaches both scans."""
    if user_id is not None:
        gold, state = gold.filter(F.col("user_id") == user_id), state.filter(F.col("user_id") == user_id)
    rewards = state.select("user_id", "total_points", "badges", "workout_count", "last_day")
    return (
        activity_profile(gold)
        .join(rewards, "user_id", "left")
        .withColumns(
            {
                "total_points": F.coalesce("total_points", F.lit(0)).cast("bigint"),
                "workout_count": F.coalesce("workout_count", F.lit(0)).cast("bigint"),
                "badges": F.coalesce("badges", F.array().cast("array<string>")),
            }
        )
    )


def sedentary_share(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Share of sedentary users (level of their mean day) and of sedentary days, in percent."""
    per_user = gold.groupBy("user_id").agg(
        F.avg("total_steps").alias("mean_steps"),
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("activity_level") == t.level_floor).alias("sedentary_days"),
    )
    idle_user = X.activity_level(F.col("mean_steps"), t) == t.level_floor
    return per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(idle_user).alias("sedentary_users"),
        F.round(F.avg(X.flag(idle_user)) * 100, 2).alias("sedentary_users_pct"),
        F.sum("days").alias("days"),
        F.sum("sedentary_days").alias("sedentary_days"),
        F.round(F.try_divide(F.sum("sedentary_days"), F.sum("days")) * 100, 2).alias("sedentary_days_pct"),
    )


def fraud_explain(fraud: DataFrame, user_id: str | None = None, t: Thresholds = DEFAULTS) -> DataFrame:
    """Suspicious days with the numbers behind the verdict, of one user or of all."""
    rows = fraud if user_id is None else fraud.filter(F.col("user_id") == user_id)
    return (
        rows.filter(X.is_fraud(F.col("anomaly_score"), t))
        .select(
            "user_id",
            F.make_date("year", "month", "day").alias("activity_date"),
            "total_steps",
            (F.col("total_steps") - t.fraud_steps).alias("steps_over_limit"),
            "active_minutes",
            "max_steps_in_minute",
            "anomaly_score",
            "fraud_reason",
        )
        .orderBy("user_id", "activity_date")
    )


def run_sql(spark: SparkSession, views: Mapping[str, DataFrame], text: str) -> DataFrame:
    """Spark SQL over named tables; the answer keeps its types. The names are gone once the text is resolved."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def try_sql(spark: SparkSession, views: Mapping[str, DataFrame], text: str) -> tuple[DataFrame | None, str | None]:
    """(answer, None), or (None, reason) for SQL that does not resolve."""
    try:
        return run_sql(spark, views, text), None
    except PySparkException as error:
        return None, str(error)
