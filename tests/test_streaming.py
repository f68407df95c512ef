import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from stridelake.operators import events as E
from stridelake.operators import gold as G
from stridelake.operators import rewards as W
from stridelake.operators import rules as R
from stridelake.operators import silver as S
from stridelake.plans import adapters as A
from stridelake.plans import registry
from stridelake.schemas import CORRUPT
from stridelake.sources import readers, sinks
from stridelake.streaming import follow, sources, stages, tables

SF = "/root/testdata/sf0.001"
RAW = "user_id string, timestamp string, steps string, calories string, intensity string, sleep_value string, ingest_time string"


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    keys = ("user_id", "timestamp", "steps", "calories", "intensity", "sleep_value", "ingest_time")
    (folder / name).write_text("".join(json.dumps(dict(zip(keys, r))) + "\n" for r in rows))


def minute(user, day, hour, steps, seq="1"):
    return (user, f"1/{day}/2024 {hour}:00:00 AM", str(steps), "1", "1", None, seq)


def silver_run(spark, root, preset="batch"):
    raw = sources.bronze_stream(spark, f"{root}/raw", f"{root}/schema", max_files=1)
    rows = stages.silver_stream(raw, preset).drop(CORRUPT)
    query = tables.run(rows, f"{root}/ck", tables.silver_sink(f"{root}/silver", "ingest_time"))
    query.awaitTermination()
    return query


def gold_run(spark, root):
    follow.gold(spark, f"{root}/silver", f"{root}/gold")
    return {(r.user_id, r.day): r.total_steps for r in readers.read_gold(spark, f"{root}/gold/daily").collect()}


def test_silver_and_gold_follow_late_updates(spark, tmp_path):
    put(tmp_path / "raw", "1.json", minute("a", 1, 1, 10), minute("a", 1, 2, 20), minute("b", 1, 1, 5), (None, "bad", "1", "1", "1", None, "1"))
    silver_run(spark, tmp_path)
    assert sorted(gold_run(spark, tmp_path).values()) == [5, 30]
    # A correction, a copy, a late row of a closed day.
    put(tmp_path / "raw", "2.json", minute("a", 1, 1, 11, "2"), minute("b", 1, 1, 5, "1"), minute("b", 1, 3, 1))
    query = silver_run(spark, tmp_path)
    assert sorted(gold_run(spark, tmp_path).values()) == [6, 31]
    assert stages.observed_totals(query)["total_rows"] == 3
    sources_seen = readers.read_silver(spark, f"{tmp_path}/silver").select("source_file").distinct().collect()
    assert {r.source_file.split("/")[-1] for r in sources_seen} <= {"1.json", "2.json"}


def test_fail_rule_stops_the_stream(spark, tmp_path):
    put(tmp_path / "raw", "1.json", ("a", "bad", "1", "1", "1", None, "1"))
    with pytest.raises(StreamingQueryException, match="timestamp_not_null"):
        silver_run(spark, tmp_path, "stream")


def test_new_column_is_picked_up_on_restart(spark, tmp_path):
    put(tmp_path / "raw", "1.json", minute("a", 1, 1, 10))
    assert "heart_rate" not in sources.bronze_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/schema").columns
    import os, time

    (tmp_path / "raw" / "2.json").write_text('{"user_id": "a", "heart_rate": 60}\n')
    os.utime(tmp_path / "raw" / "2.json", (time.time() + 5, time.time() + 5))
    assert "heart_rate" in sources.bronze_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/schema").columns


def test_watermarked_dedup_equals_batch(spark, tmp_path):
    A.minute_raw(spark, SF).repartition(3).write.json(f"{tmp_path}/raw")
    raw = sources.bronze_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/schema")
    rows = stages.silver_stream(raw, "batch", watermark="60 days").select("user_id", "timestamp", "steps")
    rows.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).option(
        "checkpointLocation", f"{tmp_path}/ck").start().awaitTermination()
    batch = A.silver(spark, SF).select("user_id", "timestamp", "steps")
    assert sorted(spark.table("deduped").collect()) == sorted(batch.collect())


def test_closed_days_wait_for_the_watermark(spark, tmp_path):
    silver = A.silver(spark, SF)
    silver.repartition(1).write.parquet(f"{tmp_path}/silver")
    stream = sources.parquet_stream(spark, f"{tmp_path}/silver", silver.schema)
    stages.closed_days_stream(stream, "2 days", full=False).writeStream.format("memory").queryName("closed").trigger(
        availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start().awaitTermination()
    closed = {tuple(r) for r in spark.table("closed").select(*G.DAY_KEYS, "total_steps").collect()}
    every = {tuple(r) for r in G.gold_daily(silver).select(*G.DAY_KEYS, "total_steps").collect()}
    last = max(r[3] for r in every)
    assert closed and closed == {r for r in every if r[3] < last - 2} | {r for r in closed if r[3] >= last - 2}
    assert closed <= every and len(closed) < len(every)


def test_running_totals_with_upsert(spark, tmp_path):
    silver = A.silver(spark, SF)
    silver.repartition(3).write.parquet(f"{tmp_path}/silver")
    stream = sources.parquet_stream(spark, f"{tmp_path}/silver", silver.schema, max_files=1)
    totals = stages.day_totals_stream(stream, full=False).withColumn("processed_at", F.current_timestamp())
    tables.run_to_table(totals, f"{tmp_path}/gold", f"{tmp_path}/ck", list(G.DAY_KEYS), sinks.GOLD_PARTITIONS,
                        "processed_at", mode="update").awaitTermination()
    got = readers.read_gold(spark, f"{tmp_path}/gold").drop("processed_at")
    want = G.gold_daily(silver).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_gold_files_trigger_events(spark, tmp_path):
    gold = A.gold_scaled(spark, SF)
    gold.repartition(2).write.parquet(f"{tmp_path}/gold")
    found = E.to_messages(E.detect_events(sources.parquet_stream(spark, f"{tmp_path}/gold", gold.schema)))
    found.select("body").writeStream.format("text").option("path", f"{tmp_path}/queue").option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.text(f"{tmp_path}/queue").count() == E.detect_events(gold).count()


def message(user, day, points=100):
    return json.dumps({"user_id": user, "day": day, "activity_date": f"2024-01-{day:02d}", "event_type": "WORKOUT_COMPLETED", "points": points})


def queue(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


def profiles(spark, root):
    return {r.user_id: (r.total_points, r.workout_count, r.last_day) for r in readers.read_state(spark, f"{root}/state").collect()}


def test_rewards_survive_any_replay(spark, tmp_path):
    each = tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", f"{tmp_path}/notes", buckets=4)
    first = queue(spark, message("a", 1), message("a", 1), message("b", 1), "broken")
    second = queue(spark, message("a", 1), message("a", 2), message("c", 1, 500))
    each(first, 0)
    expected = {"a": (100, 1, 1), "b": (100, 1, 1)}
    assert profiles(spark, tmp_path) == expected
    each(first, 0)  # the whole batch again
    assert profiles(spark, tmp_path) == expected
    each(second, 1)
    expected = {"a": (200, 2, 2), "b": (100, 1, 1), "c": (500, 1, 1)}
    assert profiles(spark, tmp_path) == expected
    each(second, 1)
    each(first, 2)  # old messages delivered again later
    assert profiles(spark, tmp_path) == expected
    assert spark.read.json(f"{tmp_path}/notes").count() == 4


def test_rewards_after_a_crash_between_log_and_profiles(spark, tmp_path):
    batch = queue(spark, message("a", 1), message("b", 1))
    tables._log_new_workouts(batch, f"{tmp_path}/log", 0)
    tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=4)(batch, 0)
    assert profiles(spark, tmp_path) == {"a": (100, 1, 1), "b": (100, 1, 1)}


def test_messages_without_a_date(spark, tmp_path):
    each = tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=4)
    body = json.dumps({"user_id": "a", "day": 7, "event_type": "WORKOUT_COMPLETED", "points": 100})
    each(queue(spark, body), 0)
    each(queue(spark, body), 1)
    assert profiles(spark, tmp_path) == {"a": (100, 1, 7)}


def test_undated_messages_of_two_months_are_two_workouts(spark, tmp_path):
    def undated(day, sent):
        return json.dumps({"user_id": "a", "day": day, "event_type": "WORKOUT_COMPLETED", "points": 100, "timestamp": sent})

    each = tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=4)
    each(queue(spark, undated(7, "2024-01-07 20:00:00"), undated(31, "2024-02-01 06:00:00")), 0)
    each(queue(spark, undated(7, "2024-02-07 20:00:00"), undated(7, "2024-01-07 20:00:00")), 1)
    assert profiles(spark, tmp_path) == {"a": (300, 3, 7)}
    sent = [undated(d, s) for d, s in ((31, "2024-03-01 00:00:00"), (30, "2024-05-31 00:00:00"), (0, "2024-05-31 00:00:00"), (40, "2024-05-31 00:00:00"), (1, "never"))]
    found = [r.activity_date for r in E.decode_messages(queue(spark, *sent)).collect()]
    assert found == [dt.date(2024, 1, 31), dt.date(2024, 5, 30), dt.date(2024, 5, 31), dt.date(2024, 5, 31), None]


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=4)(queue(spark, message("a", 1)), 0)
    with pytest.raises(ValueError, match="4 buckets, not 64"):
        tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=64)(queue(spark, message("b", 1)), 1)
    assert profiles(spark, tmp_path) == {"a": (100, 1, 1)}


def test_counts_of_all_batches_are_kept(spark, tmp_path):
    for i in range(6):
        put(tmp_path / "raw", f"{i}.json", minute("a", 1, i + 1, 300), minute("", 1, i + 1, 5))
    raw = sources.bronze_stream(spark, f"{tmp_path}/raw", f"{tmp_path}/schema", max_files=1).drop(CORRUPT)
    each = tables.counted(f"{tmp_path}/counts", R.STREAM_RULES, tables.silver_sink(f"{tmp_path}/silver", "ingest_time"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        tables.run(raw, f"{tmp_path}/ck", each).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    got = {r.rule: (r.total_rows, r.failed_rows) for r in tables.expectation_totals(spark, f"{tmp_path}/counts").collect()}
    assert got["valid_steps_range"] == (12, 6) and got["user_id_not_null"] == (12, 6) and got["valid_intensity"] == (12, 0)
    assert readers.read_silver(spark, f"{tmp_path}/silver").count() == 6


def test_raw_files_of_the_queries_keep_all_tasks_busy(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), i % 7, "view", 5.0, json.dumps({"k": 50})) for i in range(40 * cores)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    root = registry._streamed(spark, str(tmp_path), lambda session, root: seen.append(root))
    files = list((tmp_path.__class__(root.removeprefix("file:")) / "raw").glob("part-*"))
    assert len(seen) == 2 and len(files) == 2 * cores
    assert readers.read_silver(spark, f"{root}/silver").count() == len(rows)
