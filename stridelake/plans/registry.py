"""Registered queries: operator name -> ``(spark, sf_dir) -> DataFrame`` over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.config import FEATURES, FRAUD
from stridelake.functions import columns as X
from stridelake.operators import change as C
from stridelake.operators import events as E
from stridelake.operators import features as D
from stridelake.operators import gold as G
from stridelake.operators import ml as M
from stridelake.operators import report as P
from stridelake.operators import retention as T
from stridelake.operators import rewards as W
from stridelake.operators import rules as R
from stridelake.operators import silver as S
from stridelake.plans import adapters as A
from stridelake.schemas import CORRUPT
from stridelake.session import cut, pin, scratch
from stridelake.sources import readers, sinks, versions
from stridelake.streaming import bronze, follow, sources, stages, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _text(badges: str):
    """Badge lists are compared as text."""
    return F.concat_ws("|", badges).alias(badges)


# --- sources and silver ---


@query
def scan_parquet(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "value"]
    return readers.scan_parquet(spark, f"{sf_dir}/events.parquet", columns, F.col("event_type") != "error")


@query
def silver_typed(spark, sf_dir):
    return S.typed(A.minute_raw(spark, sf_dir))


@query
def silver_clean(spark, sf_dir):
    return S.clean(S.typed(A.minute_raw(spark, sf_dir)), "batch")


@query
def silver_dedup(spark, sf_dir):
    return S.dedup(S.clean(S.typed(A.minute_raw(spark, sf_dir)), "batch"))


@query
def mask_user(spark, sf_dir):
    users = A.table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", X.mask_user(F.col("user_id")).alias("masked"),
                        X.mask_user(F.col("user_id"), 16).alias("masked_long"))


@query
def silver_enriched(spark, sf_dir):
    return A.silver(spark, sf_dir)


@query
def silver_expect_drop(spark, sf_dir):
    rules = R.with_action(R.STREAM_RULES, "timestamp_not_null", "drop")
    return S.clean(S.typed(A.minute_raw(spark, sf_dir)), rules)


@query
def silver_quality_report(spark, sf_dir):
    return R.quality_report(S.typed(A.minute_raw(spark, sf_dir)))


@query
def expectations_report(spark, sf_dir):
    typed = S.typed(A.minute_raw(spark, sf_dir))
    return R.rules_report(typed, [*R.STREAM_RULES, *R.BRONZE_CATALOG[2:]])


@query
def validate_events(spark, sf_dir):
    checked = R.validate_events(A.minute_raw(spark, sf_dir))
    return checked.withColumn("errors", F.concat_ws("; ", "errors"))


@query
def quarantine(spark, sf_dir):
    _, bad = R.split_valid(R.validate_events(A.minute_raw(spark, sf_dir)))
    return bad.withColumn("errors", F.concat_ws("; ", "errors"))


@query
def layer_quality(spark, sf_dir):
    raw = A.minute_raw(spark, sf_dir)
    silver = A.silver(spark, sf_dir)
    return R.layer_quality(S.typed(raw), silver, G.gold_daily(silver, full=True))


@query
def minute_merge(spark, sf_dir):
    return S.minute_merge(*A.minute_tables(spark, sf_dir))


@query
def bronze_event_json(spark, sf_dir):
    good, _ = R.split_valid(R.validate_events(S.minute_merge(*A.minute_tables(spark, sf_dir))))
    return sinks.bronze_json(good, A.SOURCE, F.lit(A.SENT_AT).cast("timestamp_ntz"))


# --- gold ---


@query
def gold_daily(spark, sf_dir):
    return G.gold_daily(A.silver(spark, sf_dir))


@query
def gold_daily_full(spark, sf_dir):
    return A.gold_scaled(spark, sf_dir)


@query
def gold_fraud(spark, sf_dir):
    return G.gold_fraud(A.gold_scaled(spark, sf_dir))


@query
def gold_insurance(spark, sf_dir):
    return G.gold_insurance(G.gold_fraud(A.gold_scaled(spark, sf_dir)))


@query
def warehouse_daily_summary(spark, sf_dir):
    return sinks.warehouse_rows(A.gold_scaled(spark, sf_dir))


@query
def warehouse_count(spark, sf_dir):
    sinks.load_warehouse(spark, A.gold_scaled(spark, sf_dir), "daily_summary_loaded", scratch(spark, "warehouse"))
    return spark.table("daily_summary_loaded").agg(F.count(F.lit(1)).alias("row_count"))


# --- daily and hourly features ---


def _fact(spark, sf_dir):
    return D.daily_fact(*A.daily_tables(spark, sf_dir))


def _flags(spark, sf_dir):
    return D.daily_flags(_fact(spark, sf_dir))


@query
def daily_fact(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def daily_flags(spark, sf_dir):
    return _flags(spark, sf_dir)


@query
def user_summary(spark, sf_dir):
    return D.user_summary(_flags(spark, sf_dir))


@query
def engagement_7d(spark, sf_dir):
    return D.engagement_7d(_flags(spark, sf_dir)).select(
        "user_id", "activity_date", "is_engaged_day", "engaged_days_last_7", "engagement_ratio_7d"
    )


@query
def steps_delta(spark, sf_dir):
    return D.steps_delta(_fact(spark, sf_dir)).select(
        "user_id", "activity_date", "daily_steps", "yesterday_steps", "delta_steps_vs_yesterday",
        "steps_improved_vs_yesterday",
    )


@query
def activity_trend(spark, sf_dir):
    return D.activity_trend(_fact(spark, sf_dir)).select(
        "user_id", "activity_date", "daily_active_minutes", "active_minutes_7d", "active_minutes_7d_prev",
        "delta_active_minutes_7d", "activity_trend_7d",
    )


@query
def activity_variance_7d(spark, sf_dir):
    return D.activity_variance_7d(_fact(spark, sf_dir)).select(
        "user_id", "activity_date", F.round("activity_variance_7d", 6).alias("activity_variance_7d")
    )


@query
def active_streaks(spark, sf_dir):
    return D.streaks(_flags(spark, sf_dir), "is_engaged_day").select(
        "user_id", F.col("streak_group").alias("active_group"), F.col("streak_days").alias("activity_day_streak"),
        "first_date", "last_date",
    )


@query
def active_streaks_by_date(spark, sf_dir):
    return D.streaks(_flags(spark, sf_dir), "is_engaged_day", by="date").select(
        "user_id", F.col("streak_days").alias("activity_day_streak"), "first_date", "last_date"
    )


@query
def sedentary_streaks(spark, sf_dir):
    return D.streaks(_flags(spark, sf_dir), "low_sedentary", on_value=0).select(
        "user_id", F.col("streak_group").alias("sedentary_group"),
        F.col("streak_days").alias("sedentary_day_streak"), "first_date", "last_date",
    )


@query
def reward_eligibility(spark, sf_dir):
    return D.reward_eligibility(_flags(spark, sf_dir)).select(
        "user_id", "activity_date", "active_days_7d", "activity_day_streak", "sedentary_day_streak", "reward_eligible"
    )


@query
def peak_hour(spark, sf_dir):
    return D.peak_hour(D.hourly_fact(*A.hourly_tables(spark, sf_dir)))


@query
def hourly_features(spark, sf_dir):
    return D.hourly_features(D.hourly_fact(*A.hourly_tables(spark, sf_dir)))


@query
def feature_store(spark, sf_dir):
    df = D.feature_store(A.gold_scaled(spark, sf_dir))
    rounded = {c: F.round(c, 6) for c in ("steps_7day_avg", "steps_7day_std", "calories_avg", "sleep_avg")}
    return df.withColumns(rounded)


@query
def feature_store_asof(spark, sf_dir):
    """Five runs over a growing daily table; before the fourth, some days of earlier runs change."""
    root = scratch(spark, "features")
    gold, month = A.gold_scaled(spark, sf_dir), F.make_date("year", "month", "day")
    versions.commit(gold.withColumn("seq", F.lit(0)), f"{root}/daily", sinks.GOLD_PARTITIONS)
    first, last = gold.agg(F.min(month), F.max(month)).first()
    step = (last - first) / 5
    for run in range(1, 6):
        if run == 4:
            changed = versions.read(spark, f"{root}/daily").filter("day % 3 = 1 and anomaly_score > 0.1").withColumns({"total_steps": F.col("total_steps") + 7, "seq": F.lit(1)})
            versions.upsert(changed, f"{root}/daily", G.DAY_KEYS, sinks.GOLD_PARTITIONS, "seq")
        follow.features(spark, f"{root}/daily", f"{root}/store", str(first + step * run), buckets=8)
    rounded = {c: F.round(c, 6) for c in ("steps_7day_avg", "steps_7day_std", "calories_avg", "sleep_avg")}
    return versions.read(spark, f"{root}/store/features").drop("year", "month", "run").withColumns(rounded)


@query
def feature_asof_join(spark, sf_dir):
    gold = A.gold_scaled(spark, sf_dir)
    events = E.detect_events(gold).select("user_id", "activity_date", "event_type")
    known, _ = D.features_as_of(D.feature_days(gold), spark.createDataFrame([], D.FEATURE_STATE))
    known = known.filter("same_steps_streak = 1").select("user_id", F.col("activity_date").alias("feature_date"), F.round("steps_7day_avg", 6).alias("steps_7day_avg"))
    return D.as_of_join(events, known, ["user_id"], "activity_date", "feature_date", strict=True)


# --- events and rewards ---


@query
def detect_events(spark, sf_dir):
    return E.detect_events(A.gold_scaled(spark, sf_dir))


@query
def event_messages(spark, sf_dir):
    return E.to_messages(E.detect_events(A.gold_scaled(spark, sf_dir)), F.lit(A.SENT_AT).cast("timestamp_ntz"))


@query
def reward_decode(spark, sf_dir):
    return E.decode_messages(A.messages(spark, sf_dir))


@query
def event_routing(spark, sf_dir):
    routed = E.with_route(E.decode_messages(A.messages(spark, sf_dir)))
    return routed.select("user_id", "activity_date", "event_type", "route")


@query
def event_counts(spark, sf_dir):
    return E.event_counts(
        R.validate_events(A.minute_raw(spark, sf_dir)),
        A.gold_scaled(spark, sf_dir),
        E.decode_messages(A.messages(spark, sf_dir)),
    )


def _state(spark, sf_dir):
    return W.reward_state(E.decode_messages(A.messages(spark, sf_dir)))


@query
def reward_state(spark, sf_dir):
    return _state(spark, sf_dir).withColumn("badges", _text("badges"))


@query
def badge_unlocks(spark, sf_dir):
    return W.badge_unlocks(W.workout_progress(E.decode_messages(A.messages(spark, sf_dir))))


@query
def notifications(spark, sf_dir):
    events = E.detect_events(A.gold_scaled(spark, sf_dir))
    return E.notifications(events, W.workout_progress(events))


# --- reports ---


@query
def leaderboard(spark, sf_dir):
    return P.leaderboard(_state(spark, sf_dir)).select(
        "user_id", "total_points", _text("badges"), "workout_count", "last_day"
    )


@query
def top_users(spark, sf_dir):
    return P.top_users(A.gold_scaled(spark, sf_dir))


@query
def user_profile(spark, sf_dir):
    profile = P.user_profile(A.gold_scaled(spark, sf_dir), _state(spark, sf_dir))
    return profile.withColumn("badges", _text("badges"))


@query
def sedentary_share(spark, sf_dir):
    return P.sedentary_share(A.gold_scaled(spark, sf_dir))


@query
def fraud_explain(spark, sf_dir):
    return P.fraud_explain(G.gold_fraud(A.gold_scaled(spark, sf_dir)))


ADHOC = """
SELECT activity_level, count(*) AS days, CAST(sum(total_steps) AS BIGINT) AS steps, max(total_calories) AS best_calories
FROM daily_summary WHERE anomaly_score < 0.8 GROUP BY activity_level
"""


@query
def adhoc_sql(spark, sf_dir):
    return P.run_sql(spark, {"daily_summary": sinks.warehouse_rows(A.gold_scaled(spark, sf_dir))}, ADHOC)


@query
def retention_report(spark, sf_dir):
    return T.retention_report(A.listing(spark, sf_dir), F.lit(A.AS_OF).cast("timestamp_ntz"))


@query
def retention_savings(spark, sf_dir):
    return T.retention_savings(T.retention_report(A.listing(spark, sf_dir), F.lit(A.AS_OF).cast("timestamp_ntz")))


@query
def retention_filter(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    return T.within_retention(orders, F.col("order_date"), "silver", F.lit(A.AS_OF).cast("date"))


# --- files written and read back ---


def _csv(tables_, root):
    for i, df in enumerate(tables_):
        df.write.option("header", True).csv(f"{root}/{i}")
    return [f"{root}/{i}" for i in range(len(tables_))]


@query
def csv_daily_fact(spark, sf_dir):
    return D.daily_fact(*readers.read_daily_csv(spark, *_csv(A.daily_tables(spark, sf_dir), scratch(spark, "csv"))))


@query
def csv_hourly_features(spark, sf_dir):
    return D.hourly_features(D.hourly_fact(*readers.read_hourly_csv(spark, *_csv(A.hourly_tables(spark, sf_dir), scratch(spark, "csv")))))


@query
def csv_minute_merge(spark, sf_dir):
    return S.minute_merge(*readers.read_minute_csv(spark, *_csv(A.minute_tables(spark, sf_dir), scratch(spark, "csv"))))


@query
def json_bronze(spark, sf_dir):
    raw, path = A.minute_raw(spark, sf_dir), scratch(spark, "json")
    sinks.write_json_lines(raw.select(F.to_json(F.struct(*raw.columns)).alias("value")), path)
    return S.typed(readers.read_bronze_json(spark, path)).select(*raw.columns)


def _event_lines(spark, sf_dir):
    """Daily rows as JSON lines; those of the second day of a month come once more, broken off."""
    gold, path = A.gold_scaled(spark, sf_dir, full=False), scratch(spark, "lines")
    line = F.to_json(F.struct(*gold.columns))
    copies = F.when(F.col("day") == 2, F.array(line, F.concat(F.lit("broken "), line))).otherwise(F.array(line))
    sinks.write_json_lines(gold.select(F.explode(copies).alias("value")), path)
    return readers.read_event_lines(spark, path)


@query
def event_lines(spark, sf_dir):
    return _event_lines(spark, sf_dir)[0]


@query
def event_lines_refused(spark, sf_dir):
    user = F.regexp_extract("value", '"user_id":"([^"]*)"', 1).alias("user_id")
    return _event_lines(spark, sf_dir)[1].groupBy(user).agg(F.count(F.lit(1)).alias("row_count"))


@query
def silver_written(spark, sf_dir):
    path = scratch(spark, "silver")
    sinks.write_silver(A.silver(spark, sf_dir), path)
    return readers.read_silver(spark, path)


@query
def gold_written(spark, sf_dir):
    path = scratch(spark, "gold")
    sinks.write_gold(A.gold_scaled(spark, sf_dir), path)
    return readers.read_gold(spark, path)


@query
def managed_gold(spark, sf_dir):
    sinks.managed_table(A.gold_scaled(spark, sf_dir), "managed_gold", sinks.GOLD_PARTITIONS, scratch(spark, "managed"))
    return spark.table("managed_gold")


@query
def predictions_files(spark, sf_dir):
    rows, path = M.predictions(A.scored(spark, sf_dir)), scratch(spark, "predictions")
    sinks.write_predictions(rows, path, "2024-02-01", "gold")
    total = spark.read.schema("total_users long").json(f"{path}/summaries").select("total_users")
    return spark.read.schema(rows.schema).json(f"{path}/predictions").drop("run_date").join(total)


@query
def training_csv(spark, sf_dir):
    data, path = M.training_set(A.gold_scaled(spark, sf_dir)), scratch(spark, "training")
    sinks.write_training_csv(data, path)
    columns = data.select("label", *FEATURES).schema
    sides = [spark.read.schema(columns).csv(f"{path}/{side}").withColumn("split", F.lit(side)) for side in ("train", "test")]
    return sides[0].unionByName(sides[1])


# --- change data ---


def _versions(spark, sf_dir):
    """(silver before, silver after): the stored table and the same with changes applied."""
    base = cut(A.silver(spark, sf_dir).withColumn("seq", F.lit(0)))
    return base, C.cdc_apply(base, A.change_rows(base), S.KEYS, "seq")


@query
def cdc_apply(spark, sf_dir):
    return _versions(spark, sf_dir)[1]


@query
def snapshot_diff(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    return C.snapshot_diff(old, new, S.KEYS)


def _three_versions(spark, sf_dir, path):
    """Silver in versions: the table, changes applied, and a column added to some rows."""
    base = A.silver(spark, sf_dir).withColumn("seq", F.lit(0))
    versions.commit(base, path, sinks.SILVER_PARTITIONS, cluster_by=S.KEYS)
    yield 1
    versions.upsert(A.change_rows(versions.read(spark, path)), path, S.KEYS, sinks.SILVER_PARTITIONS, "seq")
    yield 2
    measured = versions.read(spark, path).filter("sleep_value = 1")
    measured = measured.withColumns({"heart_rate": 60 + F.col("intensity"), "seq": F.col("seq") + 10})
    versions.upsert(measured, path, S.KEYS, sinks.SILVER_PARTITIONS, "seq")
    yield 3


@query
def feed_between_versions(spark, sf_dir):
    path = scratch(spark, "versions")
    last = list(_three_versions(spark, sf_dir, path))[-1]
    feeds = [versions.feed_between(spark, path, S.KEYS, old, old + 1).withColumn("since", F.lit(old)) for old in range(1, last)]
    return feeds[0].unionByName(feeds[1], allowMissingColumns=True)


@query
def gold_partials(spark, sf_dir):
    root = scratch(spark, "partials")
    for _ in _three_versions(spark, sf_dir, f"{root}/silver"):
        follow.partial_days(spark, f"{root}/silver", f"{root}/partial")
    return G.classify(G.partial_totals(versions.read(spark, f"{root}/partial")))


@query
def gold_followed(spark, sf_dir):
    root = scratch(spark, "followed")
    for _ in _three_versions(spark, sf_dir, f"{root}/silver"):
        follow.gold(spark, f"{root}/silver", f"{root}/gold")
    return versions.read(spark, f"{root}/gold/insurance").drop("processed_at", follow.SEQUENCE)


@query
def gold_expectations(spark, sf_dir):
    root = scratch(spark, "expected")
    next(_three_versions(spark, sf_dir, f"{root}/silver"))
    follow.gold(spark, f"{root}/silver", f"{root}/gold")
    return follow.expectation_counts(spark, f"{root}/gold/daily").unionByName(follow.expectation_counts(spark, f"{root}/gold/fraud"))


@query
def gold_incremental(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    new = cut(new)
    return G.gold_incremental(new, G.gold_daily(old), C.snapshot_diff(old, new, S.KEYS))


# --- model ---


@query
def training_set(spark, sf_dir):
    return M.training_set(A.gold_scaled(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return M.label_distribution(A.gold_scaled(spark, sf_dir))


@query
def decode_prediction(spark, sf_dir):
    raw = F.col("raw_prediction")
    return A.scored(spark, sf_dir).select(
        "user_id",
        X.date_label(F.col("year"), F.col("month"), F.col("day")).alias("date"),
        "raw_prediction",
        X.decode_prediction(raw).alias("rounded_level"),
        X.decode_prediction(raw, exact=True).alias("exact_level"),
        X.decode_fraud(raw).alias("fraud_class"),
    )


@query
def prediction_report(spark, sf_dir):
    return M.prediction_report(M.predictions(A.scored(spark, sf_dir), levels=True), by="predicted_activity")


@query
def prediction_classes(spark, sf_dir):
    return M.prediction_report(M.predictions(A.scored(spark, sf_dir)))


@query
def predictions_written(spark, sf_dir):
    """Gold files scored as they arrive, by a stream that is restarted and once more by one that has lost its checkpoint."""
    root = scratch(spark, "scoring")
    gold = A.gold_scaled(spark, sf_dir)
    each = tables.scoring_sink(f"{root}/predictions", A.with_code, "v1")
    for part, checkpoint in ((F.col("day") <= 15, "a"), (F.col("day") > 15, "a"), (F.lit(False), "b")):
        gold.filter(part).coalesce(2).write.mode("append").parquet(f"{root}/gold")
        arriving = sources.arriving_gold(spark, f"{root}/gold", gold.schema, max_files=1)
        tables.run(arriving, f"{root}/checkpoint-{checkpoint}", each).awaitTermination()
    return versions.read(spark, f"{root}/predictions").drop("source_file", "scored_at", "run", "year", "month")


# --- streams, run to the end of the data and read back ---


def _files_of_a_batch(spark):
    """Files that arrive together. A compressed file is read by one task, so there are as many as tasks run at a time."""
    return max(2, spark.sparkContext.defaultParallelism)


def _raw_stream(spark, sf_dir, root):
    """Raw rows as JSON files, streamed in two batches whatever their number."""
    files = _files_of_a_batch(spark)
    raw = A.minute_raw(spark, sf_dir)
    sinks.write_json_lines(raw.select(F.to_json(F.struct(*raw.columns)).alias("value")).repartition(2 * files), f"{root}/raw")
    return sources.bronze_stream(spark, f"{root}/raw", f"{root}/schema", max_files=files)


def _streamed(spark, sf_dir, then=None):
    """Folder with silver: raw rows as JSON files, streamed in several batches."""
    root = scratch(spark, "stream")
    bronze = _raw_stream(spark, sf_dir, root)
    rows = stages.silver_stream(bronze, "batch").drop(CORRUPT, *PROVENANCE)
    each = tables.silver_sink(f"{root}/silver", "ingest_time", then and partial(then, root=root))
    tables.run(rows, f"{root}/checkpoint-silver", each).awaitTermination()
    return root


PROVENANCE = ("event_type", "source", "ingestion_timestamp", "source_file", "data_source", "pipeline_name")


@query
def stream_silver(spark, sf_dir):
    return readers.read_silver(spark, f"{_streamed(spark, sf_dir)}/silver").drop("processed_at", S.USER_KEY)


@query
def stream_expectations(spark, sf_dir):
    root = scratch(spark, "stream")
    bronze = _raw_stream(spark, sf_dir, root)
    rules = R.with_action(R.STREAM_RULES, "timestamp_not_null", "drop")
    each = tables.counted(f"{root}/counts", rules, tables.silver_sink(f"{root}/silver", "ingest_time"))
    tables.run(bronze.drop(CORRUPT, *PROVENANCE), f"{root}/checkpoint", each).awaitTermination()
    return tables.expectation_totals(spark, f"{root}/counts")


def _gold_after_each_batch(spark, root):
    follow.gold(spark, f"{root}/silver", f"{root}/gold", full=False)


@query
def stream_gold(spark, sf_dir):
    root = _streamed(spark, sf_dir, _gold_after_each_batch)
    return readers.read_gold(spark, f"{root}/gold/daily").drop("processed_at", follow.SEQUENCE)


@query
def stream_rewards(spark, sf_dir):
    root = scratch(spark, "stream")
    files = _files_of_a_batch(spark)
    sinks.write_messages(A.messages(spark, sf_dir).repartition(2 * files), f"{root}/queue")
    found = sources.message_stream(spark, f"{root}/queue", max_files=files)
    each = tables.reward_sink(f"{root}/state", f"{root}/log", buckets=8)
    tables.run(found, f"{root}/checkpoint", each).awaitTermination()
    return readers.read_state(spark, f"{root}/state").withColumn("badges", _text("badges"))


@query
def profile_lookup(spark, sf_dir):
    root = scratch(spark, "profiles")
    tables.reward_sink(f"{root}/state", f"{root}/log", buckets=8)(A.messages(spark, sf_dir), 0)
    suspects = E.detect_events(A.gold_scaled(spark, sf_dir)).filter(F.col("event_type") == FRAUD).select("user_id").distinct()
    return readers.lookup_profiles(spark, f"{root}/state", suspects).withColumn("badges", _text("badges"))


# --- three loads of raw lines, the second with a new column, through bronze, quarantine and silver ---


def _loaded(spark, sf_dir):
    """Folder with the tables after three loads, each a run of the same stream."""
    root = scratch(spark, "loads")
    for load in A.loads(spark, sf_dir):
        load.coalesce(2).write.mode("append").text(f"{root}/lines")
        tables.run(bronze.line_stream(spark, f"{root}/lines"), f"{root}/checkpoint", bronze.medallion(root, delay="20 days")).awaitTermination()
    return root


NOT_LOADED = (*bronze.PROVENANCE, bronze.BATCH, "event_type", "source")


@query
def stream_drift(spark, sf_dir):
    rows = versions.read(spark, f"{_loaded(spark, sf_dir)}/bronze").drop(*NOT_LOADED)
    return rows.withColumn(bronze.RESCUED, F.to_json(bronze.RESCUED))


@query
def stream_bronze(spark, sf_dir):
    root = _loaded(spark, sf_dir)
    rows, refused = (versions.read(spark, f"{root}/{name}") for name in ("bronze", "quarantine"))
    silver = versions.read(spark, f"{root}/silver").select(F.lit("silver").alias("layer"))
    layers = rows.select(F.lit("bronze").alias("layer")).unionByName(silver).unionByName(
        refused.select(F.explode(bronze.REASONS).alias("reason")).select(F.concat(F.lit("quarantine: "), "reason").alias("layer")))
    return layers.groupBy("layer").agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_quarantine(spark, sf_dir):
    rows = versions.read(spark, f"{_loaded(spark, sf_dir)}/quarantine").drop(*NOT_LOADED)
    return rows.withColumns({bronze.RESCUED: F.to_json(bronze.RESCUED), bronze.REASONS: F.concat_ws("; ", bronze.REASONS)})
