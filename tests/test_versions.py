"""Versioned tables: stops, repeats, feeds, and the tables that follow them."""

import json

import pytest
from pyspark.sql import functions as F

from stridelake.operators import gold as G
from stridelake.operators import silver as S
from stridelake.plans import adapters as A
from stridelake.plans import registry
from stridelake.sources import readers, sinks, versions
from stridelake.streaming import bronze, follow, tables

SF = "/root/testdata/sf0.001"
ROW = "user_id string, day int, steps int, seq int"


def rows(spark, *items, schema=ROW):
    return spark.createDataFrame(list(items), schema)


def put(df, path, **options):
    return versions.upsert(df, path, ["user_id"], ["day"], "seq", **options)


def found(spark, path, version=None):
    return sorted(tuple(r) for r in versions.read(spark, path, version).collect())


def test_a_stop_before_publishing_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(rows(spark, ("a", 1, 5, 1), ("b", 2, 6, 1)), path)
    change = rows(spark, ("a", 1, 7, 2), ("c", 1, 8, 2))
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            put(change, path)
    assert found(spark, path) == [("a", 1, 5, 1), ("b", 2, 6, 1)] and versions.numbers(spark, path) == [1]
    put(change, path)
    assert found(spark, path) == [("a", 1, 7, 2), ("b", 2, 6, 1), ("c", 1, 8, 2)]
    assert found(spark, path, 1) == [("a", 1, 5, 1), ("b", 2, 6, 1)]
    gone = versions.expire(spark, path, keep=1)
    assert len(gone) == 1 and found(spark, path) == [("a", 1, 7, 2), ("b", 2, 6, 1), ("c", 1, 8, 2)]  # b's folder of version 1 is still named


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    base = put(rows(spark, ("a", 1, 5, 1)), path)
    put(rows(spark, ("a", 1, 6, 2)), path)
    with pytest.raises(versions.Conflict):
        versions.commit(rows(spark, ("a", 1, 9, 9)), path, ["day"], ["day=1"], base)
    assert found(spark, path) == [("a", 1, 6, 2)]
    with pytest.raises(ValueError, match="not replaced"):
        versions.append(rows(spark, ("z", 1, 1, 1)), path, ["day"], versions.load(spark, path))
    with pytest.raises(ValueError, match="column steps is int, not string"):
        put(rows(spark, ("a", 1, "x", 9), schema="user_id string, day int, steps string, seq int"), path)


def test_only_touched_folders_are_written_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    first = put(rows(spark, ("a", 1, 5, 1), ("b", 2, 6, 1), ("c", 3, 6, 1)), path)
    second = put(rows(spark, ("b", 2, 7, 2)), path)
    assert {k for k in first.folders if first.folders[k] != second.folders[k]} == {"day=2"}
    assert {f.split("/")[-2] for f in versions.read(spark, path, second, ["day=2"]).inputFiles()} == {"day=2"}
    feed = versions.feed_between(spark, path, ["user_id"], 1)
    assert {f.split("/")[-2] for f in feed.inputFiles()} == {"day=2"}
    assert sorted((r["user_id"], r["steps"], r["_change_type"]) for r in feed.collect()) == [("b", 6, "update_preimage"), ("b", 7, "update_postimage")]
    assert versions.feed_between(spark, path, ["user_id"], 0).count() == 3 and versions.feed_between(spark, path, ["user_id"], 2).count() == 0


def test_awkward_partition_values_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    kinds = ["x:1", None, "a/b", "plain", "é %"]
    df = rows(spark, *[(str(i), k, 1) for i, k in enumerate(kinds)], schema="user_id string, kind string, seq int")
    versions.upsert(df, path, ["user_id"], ["kind"], "seq")
    versions.upsert(df.withColumn("seq", F.lit(2)).withColumn("more", F.lit(1.5)), path, ["user_id"], ["kind"], "seq")
    assert sorted(((r["user_id"], r["kind"], r["seq"], r["more"]) for r in versions.read(spark, path).collect())) == [(str(i), k, 2, 1.5) for i, k in enumerate(kinds)]
    gone = df.withColumns({"seq": F.lit(3), "operation_type": F.lit("DELETE")})
    assert versions.upsert(gone, path, ["user_id"], ["kind"], "seq").folders == {} and versions.read(spark, path).count() == 0
    assert versions.upsert(df.limit(0), path, ["user_id"], ["kind"], "seq").number == 3


def test_files_of_a_skewed_day_are_of_even_size(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        big = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("user_id"), F.lit(1).alias("day"))
        small = spark.range(40).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 10 + 2).cast("int").alias("day"))
        versions.commit(big.repartition(40).unionByName(small), str(tmp_path / "t"), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = sorted(f.stat().st_size for f in (tmp_path / "t").rglob("day=1/*.parquet"))
    assert len(sizes) > 4 and sizes[1] * 2 > sizes[-1]
    assert all(len(list((tmp_path / "t").rglob(f"day={d}/*.parquet"))) == 1 for d in range(2, 12))


# --- gold follows ---


def test_gold_reads_silver_again_only_where_a_maximum_left(spark, tmp_path, monkeypatch):
    silver, partial = str(tmp_path / "silver"), str(tmp_path / "partial")
    versions.commit(A.silver(spark, SF).withColumn("seq", F.lit(0)), silver, sinks.SILVER_PARTITIONS)
    follow.partial_days(spark, silver, partial)
    opened = []
    real = versions.read

    def watched(spark_, path, version=None, only=None):
        opened.append((path, None if only is None else sorted(only)))
        return real(spark_, path, version, only)

    def totals():
        return sorted(G.partial_totals(real(spark, partial)).collect())

    def change(where, steps, **more):
        changed = S.enrich(real(spark, silver).filter(where).withColumns({"steps": steps, "seq": F.col("seq") + 1, **more}))
        versions.upsert(changed, silver, S.KEYS, sinks.SILVER_PARTITIONS, "seq")
        opened.clear()
        with monkeypatch.context() as m:
            m.setattr(versions, "read", watched)
            follow.partial_days(spark, silver, partial)
        want = G.day_totals(real(spark, silver)).select(*G.partial_totals(real(spark, partial)).columns)
        assert totals() == sorted(want.collect())
        return [only for path, only in opened[3:] if path == silver]  # after both images of the feed and the state

    top = real(spark, silver).groupBy(*G.DAY_KEYS).agg(F.max("steps").alias("top"))
    assert change("day = 3", F.col("steps") + 1) == []  # every maximum is outdone
    assert change("day = 4 and steps < 5", F.lit(0)) == []  # maxima stand or nothing but zeros is left
    peak = real(spark, silver).filter("day = 5").join(top, list(G.DAY_KEYS)).filter("steps = top").select("timestamp").first()[0]
    again = change(F.col("timestamp") == F.lit(peak), F.lit(0))
    assert again and all(day == ["year=2024/month=1/day=5"] for day in again)
    change("day = 6", F.lit(0), operation_type=F.lit("DELETE"))
    change("day = 7 and hour_of_day < 12", F.lit(0), operation_type=F.lit("DELETE"))
    version = versions.load(spark, partial).number
    follow.partial_days(spark, silver, partial)
    assert versions.load(spark, partial).number == version  # nothing new, no commit


def test_gold_tables_after_a_stop_between_them(spark, tmp_path, monkeypatch):
    silver, root = str(tmp_path / "silver"), str(tmp_path / "gold")
    steps = registry._three_versions(spark, SF, silver)
    next(steps)
    follow.gold(spark, silver, root)
    next(steps)
    with monkeypatch.context() as m:
        m.setattr(follow, "derived", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            follow.gold(spark, silver, root)
    follow.gold(spark, silver, root)
    want = G.gold_insurance(G.gold_fraud(G.gold_daily(versions.read(spark, silver), full=True)))
    got = versions.read(spark, f"{root}/insurance")
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    counts = {r["rule"]: (r["total_rows"], r["failed_rows"]) for r in follow.expectation_counts(spark, f"{root}/daily").collect()}
    assert set(counts) == {"valid_total_steps", "valid_total_calories", "valid_user_id", "valid_anomaly_score"} and counts["valid_total_steps"][0] > want.count()


# --- bronze, quarantine, silver ---


def line(user, minute, **more):
    return json.dumps({"user_id": user, "timestamp": f"1/{minute}/2024 1:00:00 AM", "steps": "1", "calories": "1", "intensity": "1", "ingest_time": "1", **more})


def lines(spark, *values):
    return spark.createDataFrame([(v, "f") for v in values], "value string, source_file string")


def test_unknown_fields_are_rescued_and_become_columns_at_once(spark, tmp_path):
    root = str(tmp_path)
    each = bronze.medallion(root)
    each(lines(spark, line("a", 1), "  ", "not json", "[1]"), 0)
    assert versions.read(spark, f"{root}/bronze").count() == 3
    each(lines(spark, line("a", 2, heart_rate=61, STEPS=7, **{"odd name": {"x": [1]}, "Heart_Rate": 5}), line("b", 2, heart_rate="62")), 1)
    each(lines(spark, line("c", 3)), 2)
    stored = {(r["user_id"]): r for r in versions.read(spark, f"{root}/bronze").filter("user_id is not null").filter("timestamp <> '1/1/2024 1:00:00 AM'").collect()}
    assert stored["a"]["heart_rate"] == "61" and stored["b"]["heart_rate"] == "62" and stored["c"]["heart_rate"] is None
    assert stored["a"]["_rescued"] == {"STEPS": "7", "odd name": '{"x":[1]}', "Heart_Rate": "5"} and stored["b"]["_rescued"] is None
    assert versions.load(spark, f"{root}/bronze").notes["columns"] == {"heart_rate": 2}
    assert readers.read_silver(spark, f"{root}/silver").count() == 4
    refused = versions.read(spark, f"{root}/quarantine").collect()
    assert sorted((r["_corrupt_record"], tuple(r["reasons"])) for r in refused) == [("[1]", ("unreadable",)), ("not json", ("unreadable",))]


def test_late_rows_and_a_batch_that_stopped_half_way(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    each = bronze.medallion(root, delay="5 days")
    each(lines(spark, line("a", 10), line("a", 2)), 0)
    batch = lines(spark, line("b", 20), line("b", 4), line("", 9), line("b", 8))
    for broken in ("append", "upsert"):  # after bronze; after quarantine
        with monkeypatch.context() as m:
            real = getattr(versions, broken)

            def stop(df, path, *args, _real=real, **options):
                if path.endswith(("quarantine", "silver")):
                    raise OSError("stopped")
                return _real(df, path, *args, **options)

            m.setattr(versions, broken, stop)
            with pytest.raises(OSError):
                each(batch, 1)
    each(batch, 1)
    each(batch, 1)  # and once more
    each(lines(spark, line("c", 14), line("c", 15)), 2)
    rows_ = {name: versions.read(spark, f"{root}/{name}") for name in ("bronze", "quarantine", "silver")}
    assert rows_["bronze"].count() == 8
    refused = sorted((r["user_id"], r["timestamp"].split("/")[1], *r["reasons"]) for r in rows_["quarantine"].collect())
    assert refused == [("", "9", "user_id_not_null"), ("b", "4", "late"), ("c", "14", "late")]
    assert sorted(r["day"] for r in rows_["silver"].collect()) == [2, 8, 10, 15, 20]


def test_a_new_column_in_the_middle_of_a_running_stream(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i, text in enumerate((line("a", 1), line("b", 2, heart_rate=61), line("c", 3))):
        (raw / f"{i}.json").write_text(text + "\n")
    stream = bronze.line_stream(spark, str(raw), max_files=1)
    tables.run(stream, f"{tmp_path}/ck", bronze.medallion(f"{tmp_path}/t")).awaitTermination()
    got = versions.read(spark, f"{tmp_path}/t/bronze")
    assert sorted(r["heart_rate"] or "" for r in got.collect()) == ["", "", "61"]
    assert got.select("batch").distinct().count() == 3 and got.filter("source_file is null or ingestion_timestamp is null").count() == 0


# --- profiles ---


def test_lookup_opens_the_buckets_asked_for(spark, tmp_path):
    state = f"{tmp_path}/state"
    tables.reward_sink(state, f"{tmp_path}/log", buckets=8)(A.messages(spark, SF), 0)
    every = readers.read_state(spark, state)
    user = every.first()["user_id"]
    one = readers.read_state(spark, state, user)
    assert [r["user_id"] for r in one.collect()] == [user]
    assert len({f.split("/")[-2] for f in one.inputFiles()}) == 1 < len({f.split("/")[-2] for f in every.inputFiles()})
    wanted = rows(spark, (user,), (user,), ("nobody",), (None,), schema="user_id string")
    assert [r["user_id"] for r in readers.lookup_profiles(spark, state, wanted).collect()] == [user]
    assert readers.read_state(spark, state, "nobody").count() == 0 and readers.read_state(spark, f"{tmp_path}/none").count() == 0


def test_rewards_over_restarts_keep_the_number_of_files_bounded(spark, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    body = lambda user, day: json.dumps({"user_id": user, "day": day, "activity_date": f"2024-01-{day:02d}", "event_type": "WORKOUT_COMPLETED", "points": 100})
    files = []
    for restart in range(3):
        for i in range(4):
            (queue / f"{restart}-{i}.txt").write_text("".join(body(f"u{(restart + i) % 3}", d) + "\n" for d in (1, 2 + restart)))
        found_ = registry.sources.message_stream(spark, str(queue), max_files=1)
        each = tables.reward_sink(f"{tmp_path}/state", f"{tmp_path}/log", buckets=2, keep=2)
        tables.run(found_, f"{tmp_path}/ck", each).awaitTermination()
        files.append(sum(1 for t in ("state", "log") for _ in (tmp_path / t).rglob("*.parquet")))
    state = {r["user_id"]: r["workout_count"] for r in readers.read_state(spark, f"{tmp_path}/state").collect()}
    assert state == {"u0": 4, "u1": 4, "u2": 4} and files[-1] <= 2 * (4 + 2) + 4


def test_users_whose_short_masks_agree_keep_their_rows(spark, tmp_path):
    from stridelake.streaming import stages

    raw = rows(spark, *[(u, "1/1/2024 1:00:00 AM", "1", "1", "1", None, "1") for u in ("a", "b", "c")],
               schema="user_id string, timestamp string, steps string, calories string, intensity string, sleep_value string, ingest_time string")
    silver = stages.silver_stream(raw, "batch", hex_chars=0)  # all masks agree
    tables.silver_sink(f"{tmp_path}/silver", "ingest_time")(silver, 0)
    got = readers.read_silver(spark, f"{tmp_path}/silver")
    assert got.count() == 3 and got.select("user_id").distinct().count() == 1


def test_warehouse_swap_is_one_step(spark, tmp_path, monkeypatch):
    gold = A.gold_scaled(spark, SF)
    path = f"{tmp_path}/w"
    n = sinks.load_warehouse(spark, gold, "swap_test", path)
    for broken in ("read", "commit"):
        with monkeypatch.context() as m:
            m.setattr(versions, broken, lambda *_, **__: (_ for _ in ()).throw(OSError("stopped")))
            with pytest.raises(OSError):
                sinks.load_warehouse(spark, gold.limit(3), "swap_test", path)
        assert spark.table("swap_test").count() == n
    assert sinks.load_warehouse(spark, gold.limit(3), "swap_test", path) == 3 == spark.table("swap_test").count()
    spark.sql("DROP TABLE swap_test")
