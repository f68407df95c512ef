"""Features as of a day, kept up by refreshes, and files scored as they arrive."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators import features as D
from stridelake.operators import gold as G
from stridelake.plans import adapters as A
from stridelake.sources import sinks, versions
from stridelake.streaming import follow, sources, tables

DAILY = "user_id string, year int, month int, day int, total_steps bigint, total_calories double, sleep_minutes bigint, seq int"


def brute(rows):
    """Features of every (user, date) from all of the user's days up to it."""
    out, by_user = {}, {}
    for u, d, steps, calories, sleep in sorted(rows, key=lambda r: (r[0], r[1])):
        own = by_user.setdefault(u, [])
        own.append((steps, calories, sleep))
        known = lambda i, last=None: [r[i] for r in (own if last is None else own[-last:]) if r[i] is not None]
        mean = lambda v: sum(v) / len(v) if v else None
        week = known(0, 7)
        spread = (sum((x - mean(week)) ** 2 for x in week) / (len(week) - 1)) ** 0.5 if len(week) > 1 else None
        run = 1
        while run < len(own) and own[-run - 1][0] == steps:
            run += 1
        out[u, d] = [mean(week), spread, mean(known(1)), mean(known(2)), run]
    return out


def stored(spark, path):
    names = ("steps_7day_avg", "steps_7day_std", "calories_avg", "sleep_avg", "same_steps_streak")
    return {(r["user_id"], r["activity_date"]): [r[n] for n in names] for r in versions.read(spark, f"{path}/features").collect()}


def same(got, want):
    assert set(got) == set(want)
    for k in want:
        assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-6) for a, b in zip(got[k], want[k])), (k, got[k], want[k])


def test_refreshes_equal_a_full_run_as_of_each_date(spark, tmp_path):
    rnd = random.Random(4)
    start = dt.date(2023, 12, 10)
    value = lambda: (rnd.choice([None, 5, 5, 7]), rnd.choice([None, 1.5, 2.25]), rnd.choice([None, 3, 4]))
    rows = {(f"u{u}", start + dt.timedelta(i)): value() for u in range(12) for i in range(60) if rnd.random() < 0.6}
    daily, store = str(tmp_path / "daily"), str(tmp_path / "store")
    seq = 0

    def put(changed, delete=False):
        nonlocal seq
        seq += 1
        df = spark.createDataFrame([(u, d.year, d.month, d.day, *v, seq) for (u, d), v in changed.items()], DAILY)
        df = df.withColumn("operation_type", F.lit("DELETE" if delete else "UPDATE"))
        versions.upsert(df, daily, G.DAY_KEYS, sinks.GOLD_PARTITIONS, "seq")

    put(rows)
    for n, days in enumerate((5, 5, 16, 30, 45, 70)):
        run = start + dt.timedelta(days)
        if n == 3:  # late and changed days, a user who is only now known in the past
            late = {("u1", start + dt.timedelta(2)): (9, 9.0, 9), ("u2", start + dt.timedelta(15)): (None, 1.0, 1), ("new", start): (1, 1.0, 1), ("u3", start + dt.timedelta(44)): (2, 2.0, 2)}
            rows |= late
            put(late)
        if n == 4:  # days that go, one user altogether
            gone = {k: v for k, v in rows.items() if k[0] == "u4" or (k[0] == "u5" and k[1] < start + dt.timedelta(20))}
            put(gone, delete=True)
            rows = {k: v for k, v in rows.items() if k not in gone}
        follow.features(spark, daily, store, str(run), buckets=4)
        same(stored(spark, store), brute([(u, d, *v) for (u, d), v in rows.items() if d <= run]))
    with pytest.raises(ValueError, match="the store is of"):
        follow.features(spark, daily, store, str(start), buckets=4)


def test_a_refresh_reads_new_days_and_state_lines_only(spark, tmp_path):
    days = [("a", dt.date(2024, 1, 1) + dt.timedelta(i), i, 1.0, 1) for i in range(40)]
    schema = "user_id string, activity_date date, total_steps bigint, total_calories double, sleep_minutes bigint"
    none = spark.createDataFrame([], D.FEATURE_STATE)
    first, state = D.features_as_of(spark.createDataFrame(days[:30], schema), none)
    assert first.count() == 30 and len(state.first()["last_rows"]) == 6
    second, state = D.features_as_of(spark.createDataFrame(days[30:], schema), state)
    assert {(r["user_id"], r["activity_date"]): r["calories_avg"] for r in second.collect()} == {("a", d[1]): 1.0 for d in days[30:]}
    got = {r["activity_date"]: r["steps_7day_avg"] for r in second.collect()}
    assert got[days[30][1]] == 27.0 and state.first()["calories_n"] == 40
    untouched, _ = D.features_as_of(spark.createDataFrame([("b", *days[0][1:])], schema), state)
    assert [r["user_id"] for r in untouched.collect()] == ["b"]


def test_as_of_join(spark):
    left = spark.createDataFrame([("a", 5, "x"), ("a", 5, "y"), ("a", 1, "z"), ("b", 9, "w"), (None, 3, "n")], "k string, t int, v string")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 7, 70), ("c", 1, 10), (None, 1, 11)], "k string, at int, n int")
    got = {(r["v"], r["at_as_of"], r["n"]) for r in D.as_of_join(left, right, ["k"], "t", "at").collect()}
    assert got == {("x", 5, 50), ("y", 5, 50), ("z", None, None), ("w", None, None), ("n", 1, 11)}
    strict = {(r["v"], r["n"]) for r in D.as_of_join(left, right, ["k"], "t", "at", strict=True).collect()}
    assert strict == {("x", 20), ("y", 20), ("z", None), ("w", None), ("n", 11)}
    assert D.as_of_join(left.limit(0), right, ["k"], "t", "at").count() == 0


def test_each_file_is_scored_once(spark, tmp_path):
    gold = A.gold_scaled(spark, "/root/testdata/sf0.001")
    gold.coalesce(1).write.parquet(f"{tmp_path}/gold")
    scored = []

    def score(rows):
        scored.append(rows.count())
        return A.with_code(rows)

    def run(checkpoint, version="v1"):
        arriving = sources.arriving_gold(spark, f"{tmp_path}/gold", gold.schema, max_files=1)
        tables.run(arriving, f"{tmp_path}/{checkpoint}", tables.scoring_sink(f"{tmp_path}/out", score, version)).awaitTermination()
        return versions.read(spark, f"{tmp_path}/out")

    n = gold.count()
    assert run("a").count() == n and run("a").count() == n and run("b").count() == n  # restart; lost checkpoint
    assert scored == [n, 0]
    gold.filter("day = 2").withColumn("total_steps", F.lit(49).cast("bigint")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/gold")
    again = run("a")
    assert again.count() == n and {r["raw_prediction"] for r in again.filter("date like '%-2'").collect()} == {4.9}
    assert run("c", "v2").groupBy("model_version").count().count() == 2
