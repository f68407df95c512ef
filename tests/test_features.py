import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from stridelake.operators import features as D

FACT = ("user_id bigint, activity_date date, daily_steps int, SedentaryMinutes int, FairlyActiveMinutes int, "
        "VeryActiveMinutes int, is_engaged_day int, low_sedentary int")


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def fact(spark, flags, gaps=(), user=1, steps=None):
    rows, n = [], 0
    for i, f in enumerate(flags):
        n += 3 if i in gaps else 1
        rows.append((user, day(n), (steps or flags)[i], 500, 10 * i, i, f, f))
    return spark.createDataFrame(rows, FACT)


def current(df, flag="is_engaged_day", on=1, by="row"):
    return [r.s for r in D.current_streak(df, flag, "s", on, by).orderBy("activity_date").collect()]


def test_current_streak(spark):
    flags = [1, 1, 0, 1, 1, 1]
    assert current(fact(spark, flags)) == [1, 2, 0, 1, 2, 3]
    assert current(fact(spark, flags), "low_sedentary", 0) == [0, 0, 1, 0, 0, 0]
    assert current(fact(spark, [0, 0])) == [0, 0]
    assert current(fact(spark, [1])) == [1]


def test_gap_breaks_only_by_date(spark):
    df = fact(spark, [1, 1, 1, 1], gaps={2})
    assert current(df) == [1, 2, 3, 4]
    assert current(df, by="date") == [1, 2, 1, 2]
    assert sorted(r.streak_days for r in D.streaks(df, "is_engaged_day").collect()) == [4]
    assert sorted(r.streak_days for r in D.streaks(df, "is_engaged_day", by="date").collect()) == [2, 2]


@settings(max_examples=8, deadline=None)
@given(flags=st.lists(st.integers(0, 1), min_size=1, max_size=30), gaps=st.sets(st.integers(0, 29)))
def test_streaks_cover_exactly_the_flagged_days(spark, flags, gaps):
    df = fact(spark, flags, gaps)
    for by in ("row", "date"):
        found = D.streaks(df, "is_engaged_day", by=by).collect()
        assert sum(r.streak_days for r in found) == sum(flags)
        assert max([r.streak_days for r in found], default=0) == max(current(df, by=by))


def test_seven_row_windows(spark):
    rows = D.activity_trend(D.engagement_7d(fact(spark, [1] * 9))).orderBy("activity_date").collect()
    assert [r.engaged_days_last_7 for r in rows] == [1, 2, 3, 4, 5, 6, 7, 7, 7]
    assert [r.engagement_ratio_7d for r in rows][:3] == [0.14, 0.29, 0.43]
    assert [r.active_minutes_7d_prev for r in rows] == [None] * 7 + [0, 11]
    assert [r.activity_trend_7d for r in rows] == ["STABLE"] * 7 + ["IMPROVING"] * 2
    assert D.activity_variance_7d(fact(spark, [1])).first().activity_variance_7d is None


def test_steps_delta(spark):
    rows = D.steps_delta(fact(spark, [0, 0, 0], steps=[5, 9, 9])).orderBy("activity_date").collect()
    assert [(r.delta_steps_vs_yesterday, r.steps_improved_vs_yesterday) for r in rows] == [(None, 0), (4, 1), (0, 0)]


def test_daily_fact_and_flags(spark):
    calories = spark.createDataFrame([(1, "4/12/2016", 1985), (2, "4/12/2016", 10)], "Id bigint, ActivityDay string, Calories int")
    steps = spark.createDataFrame([(1, "4/12/2016", 8000), (3, "4/12/2016", 1)], "Id bigint, ActivityDay string, StepTotal int")
    minutes = spark.createDataFrame([(1, "04/12/2016", 601, 0, 0, 29)], "Id bigint, ActivityDay string, SedentaryMinutes int, LightlyActiveMinutes int, FairlyActiveMinutes int, VeryActiveMinutes int")
    rows = D.daily_flags(D.daily_fact(calories, steps, minutes)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.met_steps_goal, r.met_activity_goal, r.low_sedentary, r.is_engaged_day) == (1, 0, 0, 1)


def test_hourly(spark):
    hours = [(1, "1/1/2024 1:00:00 AM", 5), (1, "1/1/2024 11:00:00 PM", 9), (1, "1/1/2024 9:00:00 PM", 9),
             (2, "1/1/2024 3:00:00 AM", None), (2, "1/1/2024 2:00:00 AM", None)]
    steps = spark.createDataFrame(hours, "Id bigint, ActivityHour string, StepTotal int")
    effort = spark.createDataFrame([(i, h, 0) for i, h, _ in hours], "Id bigint, ActivityHour string, TotalIntensity int")
    hourly = D.hourly_fact(steps, effort)
    got = {r.Id: (r.active_hours, r.avg_steps_per_hour, r.peak_activity_hour) for r in D.hourly_features(hourly).collect()}
    assert got == {1: (3, 23 / 3, 21), 2: (0, None, 2)}
    assert {r.Id: r.peak_activity_hour for r in D.peak_hour(hourly).collect()} == {1: 21, 2: 2}


def test_same_steps_streak(spark):
    gold = spark.createDataFrame(
        [("u", 2024, 1, d, s, 1.0, 1) for d, s in enumerate([5, 5, 5, None, None, 5, 6], start=1)],
        "user_id string, year int, month int, day int, total_steps bigint, total_calories double, sleep_minutes bigint")
    rows = D.feature_store(gold).orderBy("activity_date").collect()
    assert [r.same_steps_streak for r in rows] == [1, 2, 3, 1, 2, 1, 1]


def test_windows_share_one_shuffle(spark):
    df = D.reward_eligibility(fact(spark, [1, 0, 1]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
