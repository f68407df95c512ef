"""Tables that follow other tables by their versions: each reads what has changed since the version it noted last.

A target notes the source's version in the same commit as its rows, so a stop loses nothing and a repeat changes nothing.
Nothing is read but the folders that differ between the two versions, and the target's folders that they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, Thresholds
from stridelake.operators import change as C
from stridelake.operators import features as D
from stridelake.operators import gold as G
from stridelake.operators import rules as R
from stridelake.operators.silver import merge_keys
from stridelake.session import cuts
from stridelake.sources import sinks, versions
from stridelake.sources.readers import bucket_of

SEQUENCE = "source_version"


def pending(spark: SparkSession, source: str, target: str) -> tuple[int, int, versions.Version | None] | None:
    """(version noted, newest version, target's version), or None if the target is up to date."""
    known = versions.numbers(spark, source)
    base = versions.load(spark, target)
    noted = base.followed(source) if base is not None else 0
    return None if not known or known[-1] == noted else (noted, known[-1], base)


def partial_days(spark: SparkSession, silver: str, target: str) -> None:
    """Daily sums by user-day, kept up to date from both images of silver's changes. Silver rows are read again only for
    user-days whose largest minute left, and then only those days' folders."""
    todo = pending(spark, silver, target)
    if todo is None:
        return
    old, new, base = todo
    keys = merge_keys(versions.load(spark, silver, new).schema.names)
    feed = versions.feed_between(spark, silver, keys, old, new)
    with cuts(spark) as cut:
        changes = cut(G.partial_changes(feed))
        folders = versions.touched(changes, sinks.GOLD_PARTITIONS)
        state = versions.read(spark, target, base, folders)
        state = G.empty_partials(feed) if state is None else state
        merged = cut(G.merge_partials(state, changes))
        lost = merged.filter("max_lost").select(*G.DAY_KEYS)
        days = versions.touched(lost, sinks.SILVER_PARTITIONS)
        if days:
            rows = versions.read(spark, silver, new, days).join(lost, list(G.DAY_KEYS), "left_semi")
            found = rows.groupBy(*G.DAY_KEYS).agg(F.max("steps").alias("_found"))
            merged = merged.join(found, list(G.DAY_KEYS), "left").withColumn("max_steps", F.coalesce("max_steps", "_found")).drop("_found")
        versions.commit(merged.drop("max_lost"), target, sinks.GOLD_PARTITIONS, folders, base, {"followed": {silver: new}}, ["user_id", "day"])


def derived(spark: SparkSession, source: str, target: str, keys: Sequence[str], partition_by: Sequence[str],
            make: Callable[[DataFrame], DataFrame], rules: Sequence[R.Rule] = ()) -> None:
    """A table made row by row from another one's changed rows. A key that is deleted, or that ``make`` drops, goes.

    ``rules`` are counted over all rows made, then enforced; the counts of all versions add up in the target's notes.
    """
    todo = pending(spark, source, target)
    if todo is None:
        return
    old, new, base = todo
    with cuts(spark) as cut:
        feed = cut(versions.feed_between(spark, source, keys, old, new))
        made = make(C.post_images(feed).drop(C.CHANGE_TYPE, SEQUENCE, "processed_at"))
        notes: dict = {"followed": {source: new}}
        if rules:
            notes["expectations"] = _counted(made, rules, base)
        there = R.enforce(made, rules).withColumn("_there", F.lit(True))
        changes = feed.select(*keys).distinct().join(there, list(keys), "left").withColumns(
            {
                "operation_type": F.when(F.col("_there"), "UPDATE").otherwise("DELETE"),
                SEQUENCE: F.lit(new).cast("bigint"),
                "processed_at": F.current_timestamp(),
            }
        ).drop("_there")
        if versions.upsert(changes, target, keys, partition_by, SEQUENCE, notes=notes) is None:
            versions.commit(changes.drop("operation_type"), target, partition_by, (), None, notes)


def _counted(rows: DataFrame, rules: Sequence[R.Rule], base: versions.Version | None) -> dict:
    before = base.notes.get("expectations", {}) if base is not None else {}
    found = R.rules_report(rows, rules).collect()  # one line a rule
    return {r["rule"]: [a + b for a, b in zip(before.get(r["rule"], [0, 0]), (r["total_rows"], r["failed_rows"]))] for r in found}


def expectation_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came and rows that broke each rule, over all versions of a table that counts them."""
    version = versions.load(spark, path)
    found = version.notes.get("expectations", {}) if version is not None else {}
    return spark.createDataFrame([(rule, total, failed) for rule, (total, failed) in sorted(found.items())], "rule string, total_rows long, failed_rows long")


def gold(spark: SparkSession, silver: str, root: str, full: bool = True, t: Thresholds = DEFAULTS) -> None:
    """Bring the daily, fraud and insurance tables below ``root`` up to silver's newest version, each from the one before.

    The daily table counts the gold rules (warnings too), the fraud table its own.
    """
    partial_days(spark, silver, f"{root}/partial")
    keys, by = list(G.DAY_KEYS), sinks.GOLD_PARTITIONS
    derived(spark, f"{root}/partial", f"{root}/daily", keys, by, lambda rows: G.classify(G.partial_totals(rows), full, t), R.GOLD_RULES)
    derived(spark, f"{root}/daily", f"{root}/fraud", keys, by, lambda rows: G.flag_fraud(rows, t), R.FRAUD_RULES)
    derived(spark, f"{root}/fraud", f"{root}/insurance", keys, by, lambda rows: G.gold_insurance(rows, t))


# --- feature store ---


def features(spark: SparkSession, daily: str, root: str, run_date: str, buckets: int = 64) -> None:
    """Refresh the feature store below ``root`` from the daily table, as of ``run_date`` (yyyy-mm-dd).

    A run reads the days since the last run and one state line for each of their users. Users of whom a day up to the last
    run has changed since are made anew from their whole history. Days after ``run_date`` wait for their run.
    """
    state_path, table = f"{root}/state", f"{root}/features"
    base, newest = versions.load(spark, state_path), versions.numbers(spark, daily)[-1]
    last = base.notes["run"]["date"] if base is not None else None
    if last is not None and run_date < last:
        raise ValueError(f"the store is of {last}, after {run_date}")
    month = F.col("year") * 12 + F.col("month")
    date = F.make_date("year", "month", "day")
    until = versions.read(spark, daily, newest).filter((month <= _month(run_date)) & (date <= F.lit(run_date).cast("date")))
    none = spark.createDataFrame([], D.FEATURE_STATE)
    with cuts(spark) as cut:
        if base is None:
            rows, after = D.features_as_of(D.feature_days(until), none)
            gone = None
        else:
            state = versions.read(spark, state_path, base)
            feed = versions.feed_between(spark, daily, G.DAY_KEYS, base.followed(daily), newest)
            changed = cut(feed.filter(date <= F.lit(last).cast("date")).select("user_id", date.alias("activity_date"), C.CHANGE_TYPE))
            users = changed.select("user_id").distinct()
            fresh = until.filter((month >= _month(last)) & (date > F.lit(last).cast("date")))
            rows, after = D.features_as_of(D.feature_days(fresh.join(users, "user_id", "left_anti")), state.select(*none.columns))
            again, state_again = D.features_as_of(D.feature_days(until.join(users, "user_id", "left_semi")), none)
            gone = changed.filter(F.col(C.CHANGE_TYPE) == C.DELETED).select("user_id", "activity_date")
            lost = users.join(state_again, "user_id", "left_anti")  # no day is left of them
            rows, after = rows.unionByName(again), after.unionByName(state_again).unionByName(lost, allowMissingColumns=True)
        number = (base.number if base else 0) + 1
        changes = rows.withColumn("operation_type", F.lit("UPDATE"))
        if gone is not None:
            changes = changes.unionByName(gone.withColumn("operation_type", F.lit("DELETE")), allowMissingColumns=True)
        changes = cut(changes.withColumns({"year": F.year("activity_date"), "month": F.month("activity_date"), "run": F.lit(number)}))
        versions.upsert(changes, table, ["user_id", "activity_date"], sinks.GOLD_PARTITIONS, "run")
        after = cut(after.withColumns({"bucket": bucket_of(buckets), "run": F.lit(number),
                                       "operation_type": F.when(F.col("last_rows").isNull(), "DELETE").otherwise("UPDATE")}))
        notes = {"followed": {daily: newest}, "run": {"date": run_date}}
        if versions.upsert(after, state_path, ["user_id"], ["bucket"], "run", notes=notes) is None:
            versions.commit(after.drop("operation_type"), state_path, ["bucket"], (), None, notes)


def _month(date: str) -> int:
    year, month, _ = map(int, date.split("-"))
    return year * 12 + month
