import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stridelake.operators import rules as R
from stridelake.operators import silver as S

RAW = "user_id string, timestamp string, steps string, calories string, intensity string, sleep_value string"
T0 = "4/12/2016 1:00:00 AM"


def errors(spark, *row):
    df = spark.createDataFrame([row], "user_id string, timestamp string, steps string, calories string")
    return R.validate_events(df).first().errors


@pytest.mark.parametrize(
    "row, expected",
    [
        (("7", T0, "10", "5.5"), []),
        (("7", T0, "0", "0"), []),
        (("7", T0, "200", "20"), []),
        (("7", T0, "201", "20.1"), ["Steps out of range: 201", "Calories out of range: 20.1"]),
        (("7", T0, "-1", "-0.1"), ["Steps out of range: -1", "Calories out of range: -0.1"]),
        ((None, T0, "1", "1"), ["Null value in: user_id"]),
        (("  ", T0, "1", "1"), ["Null value in: user_id"]),
        ((" \t", T0, "1", "1"), ["Null value in: user_id"]),
        (("7", "bad", "1", "1"), ["Invalid timestamp format"]),
        (("7", None, "1", "1"), ["Null value in: timestamp", "Invalid timestamp format"]),
        (("7", T0, None, "1"), ["Null value in: steps", "Steps must be integer"]),
        (("7", T0, "abc", "99"), ["Steps must be integer"]),
        (("7", T0, "12.5", "1"), ["Steps must be integer"]),
        (("7", T0, "500", "abc"), ["Calories must be float", "Steps out of range: 500"]),
        (("7", T0, " 12 ", "nan"), []),
        (("7", T0, "+5", "inf"), ["Calories out of range: inf"]),
        (("7", T0, "99999999999", "1"), ["Steps out of range: 99999999999"]),
    ],
)
def test_validate_events(spark, row, expected):
    assert errors(spark, *row) == expected


def test_validate_missing_columns(spark):
    df = spark.createDataFrame([("7", "25")], "user_id string, calories string")
    assert R.validate_events(df).first().errors == [
        "Missing column: timestamp", "Missing column: steps", "Null value in: timestamp", "Null value in: steps",
        "Steps must be integer", "Invalid timestamp format", "Calories out of range: 25",
    ]


def test_split_keeps_every_row(spark):
    rows = [("7", T0, str(n), "1") for n in range(190, 210)]
    checked = R.validate_events(spark.createDataFrame(rows, "user_id string, timestamp string, steps string, calories string"))
    good, bad = R.split_valid(checked)
    assert (good.count(), bad.count()) == (11, 9)
    assert "errors" not in good.columns


def typed(spark):
    rows = [
        ("a", T0, "10", "1.0", "0", None), ("a", T0, "10", "1.0", "0", None), ("b", T0, "-1", "1", "1", "1"),
        ("c", "bad", "5", "1", "2", "2"), (None, T0, "5", "1", "3", "3"), ("d", T0, "201", "21", "4", None),
        ("e", T0, None, "1", None, None),
    ]
    return S.typed(spark.createDataFrame(rows, RAW))


def test_rules_report_counts_null_as_failed(spark):
    report = {r.rule: r.failed_rows for r in R.rules_report(typed(spark), R.STREAM_RULES).collect()}
    assert report == {"valid_steps_range": 3, "valid_calories_range": 1, "user_id_not_null": 1,
                      "timestamp_not_null": 1, "valid_intensity": 2}


def test_drop_keeps_warned_rows(spark):
    rules = R.with_action(R.STREAM_RULES, "timestamp_not_null", "drop")
    kept, report = R.apply_rules(typed(spark), rules)
    assert sorted(r.user_id for r in kept.collect()) == ["a", "a", "b"]
    assert report.count() == 5


def test_batch_preset(spark):
    assert sorted(r.user_id for r in S.clean(typed(spark), "batch").collect()) == ["a", "a", "d"]


def test_fail_stops_the_job(spark):
    with pytest.raises(PySparkException, match="timestamp_not_null"):
        R.enforce(typed(spark), R.STREAM_RULES).collect()
    with pytest.raises(PySparkException, match="timestamp_not_null"):
        R.enforce(typed(spark), R.STREAM_RULES).count()
    with pytest.raises(PySparkException, match="timestamp_not_null"):
        R.enforce(typed(spark), R.STREAM_RULES).filter("timestamp IS NOT NULL").count()


def test_quality_report(spark):
    assert R.quality_report(typed(spark)).first().asDict() == {
        "total_rows": 7, "null_timestamps": 1, "invalid_steps": 1, "invalid_calories": 0, "null_user_ids": 1,
        "duplicates_removed": 1, "final_rows": 2}


def test_quality_report_of_nothing(spark):
    assert set(R.quality_report(typed(spark).filter("false")).first()) == {0}


def test_observation(spark):
    from pyspark.sql import Observation

    seen = Observation("x")
    df = typed(spark)
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 7
