import datetime as dt

from pyspark.sql import functions as F

from stridelake.config import Thresholds
from stridelake.operators import gold as G
from stridelake.operators import silver as S

RAW = "user_id string, timestamp string, steps string, calories string, intensity string, sleep_value string, ingest_time string"


def test_typed_gives_null_for_bad_values(spark):
    df = S.typed(spark.createDataFrame(
        [("1", "4/12/2016 1:00:00 AM", s, "x", "", " 2 ", "t") for s in ("12", " 12 ", "+5", "12.5", "abc", "", "99999999999")], RAW))
    assert [r.steps for r in df.collect()] == [12, 12, 5, None, None, None, None]
    assert {(r.calories, r.intensity, r.sleep_value) for r in df.collect()} == {(None, None, 2)}


def test_dedup_keeps_latest(spark):
    rows = [("1", "4/12/2016 1:00:00 AM", "5", "1", "1", None, "2"), ("1", "4/12/2016 1:00:00 AM", "7", "1", "1", None, "3"),
            ("1", "4/12/2016 1:00:00 AM", "6", "1", "1", None, "1"), ("1", "4/12/2016 1:01:00 AM", "6", "1", "1", None, "1")]
    assert sorted(r.steps for r in S.dedup(S.typed(spark.createDataFrame(rows, RAW))).collect()) == [6, 7]


def test_dedup_limits_each_task_before_the_shuffle(spark):
    """A key with very many copies must not travel: the group limit runs on the map side too."""
    df = S.dedup(spark.range(1000).selectExpr(
        "cast(id % 2 as string) user_id", "cast(timestamp_seconds(id % 2) as timestamp_ntz) timestamp", "cast(id as int) steps"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_minute_merge_fans_out_on_sleep(spark):
    minute = "4/12/2016 1:00:00 AM"
    one = lambda value, name: spark.createDataFrame([("1", minute, value), ("2", minute, value)], f"Id string, ActivityMinute string, {name} string")
    sleep = spark.createDataFrame([("1", minute, "1", "9"), ("1", minute, "2", "10")], "Id string, date string, value string, logId string")
    merged = S.minute_merge(one("1", "Steps"), one("2", "Calories"), one("3", "Intensity"), sleep)
    assert merged.columns == ["user_id", "timestamp", "steps", "calories", "intensity", "sleep_value"]
    assert sorted((r.user_id, r.sleep_value or "") for r in merged.collect()) == [("1", "1"), ("1", "2"), ("2", "")]


def test_enrich(spark):
    df = spark.createDataFrame([("u", dt.datetime(2016, 4, 10, 23, 5), 11, 3)], "user_id string, timestamp timestamp_ntz, steps int, sleep_value int")
    r = S.enrich(df).first()
    assert (r.year, r.month, r.day, r.hour_of_day, r.day_of_week, r.is_active, r.is_sleeping) == (2016, 4, 10, 23, 1, 1, 1)


def test_mask_collisions(spark):
    ids = spark.range(3000).selectExpr("cast(id as string) user_id")
    assert S.mask_collisions(ids, 8).count() == 0
    assert S.mask_collisions(ids, 1).agg(F.sum("ids")).first()[0] == 3000


def silver_rows(spark, *steps, day=1):
    rows = [("u", 2024, 1, day, s, 0.5, 1, 0, 1) for s in steps]
    return spark.createDataFrame(rows, "user_id string, year int, month int, day int, steps int, calories double, intensity int, is_sleeping int, is_active int")


def test_gold_boundaries(spark):
    for total, score, level in [(0, 0.3, "SEDENTARY"), (999, 0.1, "SEDENTARY"), (1000, 0.1, "LOW"), (10000, 0.1, "HIGH"),
                                (12001, 0.5, "HIGH"), (15000, 0.5, "HIGH"), (15001, 0.8, "HIGH")]:
        row = G.gold_daily(silver_rows(spark, total), full=True).first()
        assert (row.anomaly_score, row.activity_level) == (score, level)


def test_fraud_reason_with_outside_score(spark):
    gold = G.gold_daily(silver_rows(spark, 10)).withColumn("anomaly_score", F.lit(0.9))
    row = G.gold_insurance(G.gold_fraud(gold)).first()
    assert (row.fraud_flag, row.fraud_reason) == ("FRAUD", "Anomaly score threshold exceeded")
    assert (row.insurance_risk_score, row.premium_adjustment) == (90, "SURCHARGE_20%")


def test_thresholds_are_parameters(spark):
    t = Thresholds(level_tiers=((1, "HIGH"),))
    assert G.gold_daily(silver_rows(spark, 5), t=t).first().activity_level == "HIGH"


def test_incremental_equals_full(spark):
    before = silver_rows(spark, 100, 200).unionByName(silver_rows(spark, 300, day=2)).unionByName(silver_rows(spark, 5, day=3))
    after = silver_rows(spark, 100).unionByName(silver_rows(spark, 301, day=2)).unionByName(silver_rows(spark, 7, day=4))
    changes = before.exceptAll(after).unionByName(after.exceptAll(before))
    got = G.gold_incremental(after, G.gold_daily(before), changes)
    assert sorted(got.collect()) == sorted(G.gold_daily(after).collect())
