import datetime as dt

from pyspark.sql import functions as F

from stridelake.operators import ml as M
from stridelake.operators import report as P
from stridelake.operators import retention as T
from stridelake.operators import rules as R
from stridelake.operators import gold as G
from stridelake.operators import silver as S
from stridelake.config import Thresholds
from stridelake.plans import adapters as A

SF = "/root/testdata/sf0.001"
AS_OF = F.lit


def test_leaderboard(spark):
    state = spark.createDataFrame([("a", 5), ("b", None), ("c", 9), ("d", 5)], "user_id string, total_points bigint")
    assert [r.user_id for r in P.leaderboard(state).collect()] == ["c", "a", "d", "b"]
    assert [r.total_points for r in P.leaderboard(state, 2).collect()] == [9, 5]


def test_profile_of_one_user_and_of_a_user_without_rewards(spark):
    gold = A.gold_scaled(spark, SF)
    user = gold.first().user_id
    state = spark.createDataFrame([], "user_id string, total_points bigint, badges array<string>, workout_count bigint, last_day int")
    row = P.user_profile(gold, state, user).collect()
    assert len(row) == 1 and (row[0].total_points, row[0].badges, row[0].last_day) == (0, [], None)


def test_sql(spark):
    views = {"t_days": spark.createDataFrame([(1, "x")], "a int, b string")}
    df, error = P.try_sql(spark, views, "SELECT a + 1 AS n FROM t_days")
    assert error is None and df.first().n == 2
    df, error = P.try_sql(spark, views, "SELECT nothing FROM t_days")
    assert df is None and "nothing" in error


def test_sample_rows(spark):
    assert A.gold_scaled(spark, SF).limit(5).count() == 5


def listing(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("bronze", "minute_data/a", 1 << 20, day), ("bronze", "minute_data/b", 1 << 20, day + dt.timedelta(hours=1)),
            ("bronze", "other/c", 1 << 20, day), ("silver", "minute_data/d", 1 << 20, day)]
    return spark.createDataFrame(rows, "store string, path string, size_bytes bigint, last_modified timestamp_ntz")


def test_retention_is_strict_in_whole_days(spark):
    def files(as_of):
        return sorted(r.path for r in T.expired(listing(spark), F.lit(as_of).cast("timestamp_ntz")).collect())

    assert files("2024-03-31 23:59:59") == []  # 90 days
    assert files("2024-04-01 00:00:00") == ["minute_data/a"]  # 91 days
    assert files("2024-04-01 01:00:00") == ["minute_data/a", "minute_data/b"]


def test_retention_report_and_note(spark):
    as_of = F.lit("2024-04-02").cast("timestamp_ntz")
    report = T.retention_report(listing(spark), as_of)
    assert {(r.store, r.prefix): (r.deleted_files, r.mb_freed) for r in report.collect()} == {
        ("bronze", "minute_data/"): (2, 2.0), ("gold", "predictions/"): (0, 0.0), ("gold", "cost-reports/"): (0, 0.0),
        ("silver", "minute_data/"): (0, 0.0)}
    note = T.cleanup_note(report, as_of).first()
    assert "Total files deleted: 2" in note.body and "Date: 2024-04-02" in note.body
    assert T.cleanup_note(report.withColumn("deleted_files", F.lit(0)), as_of).count() == 0


def test_within_retention(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),)], "d date")
    assert T.within_retention(df, F.col("d"), "silver", F.lit("2024-12-31").cast("date")).count() == 1
    assert T.within_retention(df, F.col("d"), "gold", F.lit("2024-12-31").cast("date")).count() == 2


def test_layer_quality_of_clean_layers(spark):
    raw = spark.createDataFrame(
        [("1", f"1/{d}/2024 1:00:00 AM", "5", "1", "1", None, "t") for d in (1, 2, 4)],
        "user_id string, timestamp string, steps string, calories string, intensity string, sleep_value string, ingest_time string")
    silver = S.build_silver(raw)
    lines = {(r.layer, r.rule): (r.failed_rows, r.ok) for r in R.layer_quality(S.typed(raw), silver, G.gold_daily(silver, True)).collect()}
    assert lines.pop(("gold", "complete_days")) == (1, False)
    assert set(lines.values()) == {(0, True)}


def test_model(spark):
    gold = A.gold_scaled(spark, SF)
    data = M.training_set(gold).cache()
    model = M.train(data, Thresholds(boosting_rounds=5, tree_depth=3))
    assert M.auc(model, data) > 0.95
    scored = M.score(model, gold)
    assert scored.count() == gold.count()
    assert {r.predicted_class for r in scored.select("predicted_class").distinct().collect()} == {"FRAUD", "NORMAL"}
    report = M.prediction_report(scored)
    total = report.filter("predicted_class = 'TOTAL'").first()
    assert (total.row_count, total.fraud_rows) == (gold.count(), gold.filter("anomaly_score >= 0.8").count())
    note = M.prediction_note(report, F.lit("2024-02-01").cast("date")).first()
    assert f"Total users predicted: {gold.count()}" in note.body


def test_missing_prediction(spark):
    row = M.predictions(A.scored(spark, SF).withColumn("raw_prediction", F.lit(None).cast("double"))).first()
    assert (row.raw_prediction, row.predicted_class) == (-1.0, "UNKNOWN")
