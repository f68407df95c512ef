"""Minute rows to user-days, and the decisions on a user-day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, PIPELINE_VERSION, Thresholds
from stridelake.functions import columns as X
from stridelake.operators import rules as R
from stridelake.operators.change import AFTER, CHANGE_TYPE, INSERT

DAY_KEYS = ("user_id", "year", "month", "day")


def day_aggregates() -> list[Column]:
    """The daily sums, for every grouping that makes a daily summary."""
    return [
        F.sum("steps").alias("total_steps"),
        F.sum("calories").alias("total_calories"),
        F.sum("is_active").alias("active_minutes"),
        F.sum("is_sleeping").alias("sleep_minutes"),
        F.avg("intensity").alias("avg_intensity"),
        F.max("steps").alias("max_steps_in_minute"),
        F.count(F.lit(1)).alias("total_minutes_recorded"),
    ]


def day_totals(silver: DataFrame) -> DataFrame:
    """Sums per user and day, hash-aggregated on both sides of the shuffle. Streams too (update mode)."""
    return silver.groupBy(*DAY_KEYS).agg(*day_aggregates())


def classify(totals: DataFrame, full: bool = False, t: Thresholds = DEFAULTS) -> DataFrame:
    """Score, level and rounding; ``full`` adds the risk class and the pipeline version."""
    steps = F.col("total_steps")
    df = totals.withColumns(
        {
            "total_calories": F.round("total_calories", 2),
            "avg_intensity": F.round("avg_intensity", 4),
            "anomaly_score": X.anomaly_score(steps, t),
            "activity_level": X.activity_level(steps, t),
        }
    )
    if full:
        df = df.withColumns(
            {"health_risk": X.health_risk(F.col("activity_level")), "pipeline_version": F.lit(PIPELINE_VERSION)}
        )
    return df


def gold_daily(silver: DataFrame, full: bool = False, t: Thresholds = DEFAULTS) -> DataFrame:
    """Daily summary per user. ``full`` is the variant with risk class, version and the gold rules."""
    df = classify(day_totals(silver), full, t)
    return R.enforce(df, R.GOLD_RULES) if full else df


def flag_fraud(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Fraud flag and reason of every daily row."""
    fraud = X.is_fraud(F.col("anomaly_score"), t)
    return gold.withColumns(
        {
            "fraud_flag": F.when(fraud, "FRAUD").otherwise("CLEAN"),
            "fraud_reason": F.when(F.col("total_steps") > t.fraud_steps, "Steps exceed daily maximum").when(
                fraud, "Anomaly score threshold exceeded"
            ),
        }
    )


def gold_fraud(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return R.enforce(flag_fraud(gold, t), R.FRAUD_RULES)


def gold_insurance(fraud: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return fraud.withColumn("insurance_risk_score", X.insurance_score(F.col("activity_level"), t)).withColumn(
        "premium_adjustment", X.premium(F.col("insurance_risk_score"), t)
    )


def recompute_days(silver: DataFrame, changes: DataFrame, full: bool = False, t: Thresholds = DEFAULTS) -> DataFrame:
    """Gold rows of exactly the user-days that ``changes`` touches, summed anew from silver."""
    touched = changes.select(*DAY_KEYS).distinct()
    return gold_daily(silver.join(touched, list(DAY_KEYS), "left_semi"), full, t)


def gold_incremental(silver: DataFrame, gold: DataFrame, changes: DataFrame, full: bool = False,
                     t: Thresholds = DEFAULTS) -> DataFrame:
    """Gold after a change of silver: untouched user-days as they are, touched ones recomputed.

    ``silver`` is the table after the change. Sums are never patched, so updates and deletes are
    right, and a user-day without rows left disappears.
    """
    touched = changes.select(*DAY_KEYS).distinct()
    kept = gold.join(touched, list(DAY_KEYS), "left_anti")
    return kept.unionByName(recompute_days(silver, changes, full, t))


# --- daily sums that can be added to and taken from ---

#: What is summed; intensity for its mean. Each has a sum and the number of values in it, so that no value stays NULL.
SUMMED = {"steps": "bigint", "calories": "double", "is_active": "bigint", "is_sleeping": "bigint", "intensity": "double"}


def partial_changes(feed: DataFrame) -> DataFrame:
    """What a change feed of silver adds to each user-day's sums (old images count negative), the largest new step count
    (``new_max``) and the largest one that left (``gone_max``). Old and new image of a row meet in the same aggregate."""
    comes = F.col(CHANGE_TYPE).isin(INSERT, AFTER)
    sign = F.when(comes, 1).otherwise(-1)
    sums = []
    for c, kind in SUMMED.items():
        sums += [F.sum(sign * F.coalesce(F.col(c), F.lit(0))).cast(kind).alias(f"s_{c}"), F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}")]
    return feed.groupBy(*DAY_KEYS).agg(
        F.sum(sign).alias("minutes"), *sums,
        F.max(F.when(comes, F.col("steps"))).alias("new_max"), F.max(F.when(~comes, F.col("steps"))).alias("gone_max"))


def merge_partials(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State rows after ``changes``. ``max_lost`` marks user-days whose maximum left and isn't outdone by a new one: only
    for those must the rows be looked at again. A user-day without minutes is gone."""
    names = ["minutes", *[f"{k}_{c}" for c in SUMMED for k in "sn"]]
    old = state.select(*DAY_KEYS, *[F.col(n).alias(f"_{n}") for n in names], F.col("max_steps").alias("_max"))
    added = [(F.coalesce(f"_{n}", F.lit(0)) + F.coalesce(n, F.lit(0))).alias(n) for n in names]
    rows = old.join(changes, list(DAY_KEYS), "full").select(*DAY_KEYS, *added, "_max", "new_max", "gone_max")
    stands = F.col("gone_max").isNull() | (F.col("gone_max") < F.col("_max"))
    outdone = F.coalesce(F.col("new_max") >= F.col("gone_max"), F.lit(False))
    largest = F.when(stands, F.greatest("_max", "new_max")).when(outdone, F.col("new_max"))
    lost = ~(F.coalesce(stands, F.lit(False)) | outdone) & (F.col("n_steps") > 0)
    return rows.filter("minutes > 0").select(*DAY_KEYS, *names, largest.alias("max_steps"), lost.alias("max_lost"))


def empty_partials(silver: DataFrame) -> DataFrame:
    """State without rows, with the types that ``silver`` gives it."""
    none = silver.filter(F.lit(False)).withColumn(CHANGE_TYPE, F.lit(INSERT))
    return partial_changes(none).withColumnRenamed("new_max", "max_steps").drop("gone_max")


def partial_totals(state: DataFrame) -> DataFrame:
    """The daily sums as ``day_totals`` gives them."""
    def total(c: str) -> Column:
        return F.when(F.col(f"n_{c}") > 0, F.col(f"s_{c}"))

    return state.select(
        *DAY_KEYS,
        total("steps").alias("total_steps"),
        total("calories").alias("total_calories"),
        total("is_active").alias("active_minutes"),
        total("is_sleeping").alias("sleep_minutes"),
        (total("intensity") / F.col("n_intensity")).alias("avg_intensity"),
        F.col("max_steps").alias("max_steps_in_minute"),
        F.col("minutes").alias("total_minutes_recorded"),
    )
