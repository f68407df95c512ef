import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.config import BADGES
from stridelake.functions import columns as X


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_parse_ts(spark):
    good = ["4/12/2016 12:00:00 AM", "04/12/2016 12:00:00 am", "4/12/2016 01:05:09 PM"]
    bad = ["4/12/2016 13:00:00 PM", "4/31/2016 1:00:00 AM", "4/12/16 1:00:00 AM", "2016-04-12 00:00:00", "",
           " 4/12/2016 1:00:00 AM", None]
    parsed = column(spark, good + bad, "string", X.parse_ts)
    assert parsed[:3] == [dt.datetime(2016, 4, 12), dt.datetime(2016, 4, 12), dt.datetime(2016, 4, 12, 13, 5, 9)]
    assert parsed[3:] == [None] * len(bad)


def test_parse_date(spark):
    assert column(spark, ["4/12/2016", "12/1/2016", "2016-04-12", None], "string", X.parse_date) == [
        dt.date(2016, 4, 12), dt.date(2016, 12, 1), None, None]


def test_mask_known_values(spark):
    assert column(spark, ["1503960366", "0", "", None], "string", X.mask_user) == [
        "USR_d0423022", "USR_5feceb66", None, None]


@settings(max_examples=10, deadline=None)
@given(ids=st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"])), min_size=1, max_size=20))
def test_mask_equals_hashlib(spark, ids):
    expected = ["USR_" + hashlib.sha256(i.encode()).hexdigest()[:8] if i else None for i in ids]
    assert column(spark, ids, "string", X.mask_user) == expected


STEPS = [None, 0, 1, 999, 1000, 4999, 5000, 9999, 10000, 12000, 12001, 15000, 15001]


def test_anomaly_score(spark):
    assert column(spark, STEPS, "bigint", X.anomaly_score) == [
        0.1, 0.3, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.5, 0.5, 0.8]


def test_levels_risk_premium(spark):
    levels = column(spark, STEPS, "bigint", X.activity_level)
    assert levels == ["SEDENTARY"] * 4 + ["LOW"] * 2 + ["MEDIUM"] * 2 + ["HIGH"] * 5
    names = ["HIGH", "MEDIUM", "LOW", "SEDENTARY", None]
    assert column(spark, names, "string", X.health_risk) == ["LOW_RISK", "LOW_RISK", "MEDIUM_RISK", "HIGH_RISK", "LOW_RISK"]
    scores = column(spark, names, "string", X.insurance_score)
    assert scores == [10, 30, 60, 90, 90]
    assert column(spark, scores, "int", X.premium) == [
        "DISCOUNT_10%", "STANDARD", "STANDARD", "SURCHARGE_20%", "SURCHARGE_20%"]


def test_minute_flags(spark):
    assert column(spark, [None, -1, 0, 10, 11, 200], "int", X.is_active) == [0, 0, 0, 0, 1, 1]
    assert column(spark, [None, 1, 2, 3], "int", X.is_sleeping) == [0, 1, 1, 1]


def test_fraud_ignores_nan(spark):
    assert column(spark, [0.8, 0.79, float("nan"), None], "double", X.is_fraud) == [True, False, False, None]


def test_trend(spark):
    assert column(spark, [1, -1, 0, None], "int", X.trend) == ["IMPROVING", "DECLINING", "STABLE", "STABLE"]


def test_decode_prediction(spark):
    values = [0.0, 0.5, 1.5, 2.5, 3.0, 3.5, -0.2, None]
    assert column(spark, values, "double", X.decode_prediction) == [
        "HIGH", "HIGH", "LOW", "LOW", "SEDENTARY", "UNKNOWN", "HIGH", "UNKNOWN"]
    assert column(spark, values, "double", lambda c: X.decode_prediction(c, exact=True)) == [
        "HIGH", "UNKNOWN", "UNKNOWN", "UNKNOWN", "SEDENTARY", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert column(spark, [0.2, 0.5, None], "double", X.decode_fraud) == ["NORMAL", "FRAUD", "UNKNOWN"]


def test_float_text(spark):
    values = [0.0, 10500.0, 12345678.0, 0.5, None]
    assert column(spark, values, "double", X.float_text) == ["0.0", "10500.0", "12345678.0", "0.5", None]


@pytest.mark.parametrize("held", [[], [BADGES[0][1]], [BADGES[1][1]]])
def test_badges(spark, held):
    points = [0, 99, 100, 400, 500, 1000, 4999, 5000]
    expected = [[n for limit, n in BADGES if p >= limit and n not in held] for p in points]
    got = column(spark, points, "bigint", lambda c: X.new_badges(c, F.array(*map(F.lit, held)).cast("array<string>")))
    assert got == expected


def test_split_is_stable_and_about_right(spark):
    df = spark.range(20000).select("id", X.in_train_split(0.8, 42, F.col("id")).alias("train"))
    again = spark.range(20000).repartition(7).select("id", X.in_train_split(0.8, 42, F.col("id")).alias("train"))
    assert df.exceptAll(again).count() == 0
    assert 0.78 < df.filter("train").count() / 20000 < 0.82
