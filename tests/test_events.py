import datetime as dt
import json

from pyspark.sql import functions as F

from stridelake.config import BADGES
from stridelake.operators import events as E
from stridelake.operators import rewards as W

GOLD = "user_id string, year int, month int, day int, total_steps bigint, anomaly_score double, active_minutes bigint"
SENT = F.lit


def gold(spark, *rows):
    return spark.createDataFrame([("u%d" % i, 2024, 1, i + 1, *r) for i, r in enumerate(rows)], GOLD)


def test_detect(spark):
    df = gold(spark, (20000, 0.8, 1), (10000, 0.1, 1), (9999, 0.1, 1), (0, 0.3, 0), (None, 0.1, 1), (10000, float("nan"), 1),
              (0, 0.9, 0), (0, 0.3, None))
    found = {r.user_id: (r.event_type, r.priority, r.points, r.message) for r in E.detect_events(df).collect()}
    assert found == {
        "u0": ("FRAUD_DETECTED", "HIGH", 0, "Suspicious activity! Steps: 20000.0"),
        "u1": ("WORKOUT_COMPLETED", "LOW", 100, "Amazing! You hit 10000.0 steps today!"),
        "u3": ("INACTIVITY_DETECTED", "MEDIUM", 0, "No steps today — time to move!"),
        "u5": ("WORKOUT_COMPLETED", "LOW", 100, "Amazing! You hit 10000.0 steps today!"),
        "u6": ("FRAUD_DETECTED", "HIGH", 0, "Suspicious activity! Steps: 0.0"),
    }
    _, unreadable = E.split_detectable(df)
    assert sorted(r.user_id for r in unreadable.collect()) == ["u4", "u7"]


def test_absent_column_counts_as_zero(spark):
    df = gold(spark, (0, 0.1, 0)).drop("active_minutes", "anomaly_score")
    assert E.detect_events(df).first().event_type == "INACTIVITY_DETECTED"


def decode(spark, *bodies):
    return E.decode_messages(spark.createDataFrame([(b,) for b in bodies], "body string"))


def test_message_round_trip(spark):
    events = E.detect_events(gold(spark, (10500, 0.1, 1)))
    sent = E.to_messages(events, F.lit("2026-03-23 23:00:00").cast("timestamp_ntz"))
    body = json.loads(sent.first().body)
    assert body == {"user_id": "u0", "day": 1, "activity_date": "2024-01-01", "event_type": "WORKOUT_COMPLETED",
                    "message": "Amazing! You hit 10500.0 steps today!", "priority": "LOW", "points": 100,
                    "timestamp": "2026-03-23 23:00:00"}
    back = E.decode_messages(sent).first()
    assert (back.user_id, back.activity_date, back.points, back.failed) == ("u0", dt.date(2024, 1, 1), 100, False)


def test_decode_defaults_and_failures(spark):
    rows = decode(spark, "{}", '{"user_id": "a", "points": 5, "extra": 1}', "no json", None, '{"points": "many"}').collect()
    assert [(r.user_id, r.day, r.event_type, r.points, r.failed) for r in rows] == [
        ("UNKNOWN", 0, "", 0, False), ("a", 0, "", 5, False), (None, None, None, None, True),
        (None, None, None, None, True), (None, None, None, None, True)]


def test_route(spark):
    parts = E.route(decode(spark, *[json.dumps({"event_type": k}) for k in
                    ("WORKOUT_COMPLETED", "INACTIVITY_DETECTED", "FRAUD_DETECTED", "OTHER")], "broken"))
    assert {k: v.count() for k, v in parts.items()} == {"reward": 1, "remind": 1, "skip": 1, "log": 1, "failed": 1}


MESSAGES = "user_id string, activity_date date, day int, event_type string, points int"


def workouts(spark, *rows):
    return spark.createDataFrame([(u, dt.date(2024, 1, d), d, "WORKOUT_COMPLETED", p) for u, d, p in rows], MESSAGES)


def test_rewards_jump_over_two_thresholds(spark):
    row = W.reward_state(workouts(spark, ("a", 3, 600))).first()
    assert (row.total_points, row.badges, row.workout_count, row.last_day) == (600, [BADGES[0][1], BADGES[1][1]], 1, 3)


def test_rewards_ignore_copies(spark):
    once = workouts(spark, ("a", 1, 100), ("a", 2, 100), ("b", 1, 100))
    assert sorted(W.reward_state(once).collect()) == sorted(W.reward_state(once.unionByName(once)).collect())


def test_rewards_on_top_of_state(spark):
    state = spark.createDataFrame(
        [("a", 450, [BADGES[0][1]], 4, 9, dt.date(2023, 12, 9)), ("z", 10, [], 1, 1, dt.date(2023, 12, 1))],
        "user_id string, total_points bigint, badges array<string>, workout_count bigint, last_day int, last_activity_date date")
    messages = workouts(spark, ("a", 1, 100), ("n", 2, 5000))
    rows = {r.user_id: r for r in W.reward_state(messages, state).collect()}
    assert (rows["a"].total_points, rows["a"].badges, rows["a"].workout_count) == (550, [BADGES[0][1], BADGES[1][1]], 5)
    assert rows["z"].total_points == 10 and rows["z"].last_day == 1
    assert rows["n"].badges == [n for _, n in BADGES]
    steps = {r.user_id: r for r in W.workout_progress(messages, state).collect()}
    assert (steps["a"].running_points, steps["a"].workout_number, steps["a"].new_badges) == (550, 5, [BADGES[1][1]])


def test_badge_held_without_points_is_not_given_again(spark):
    state = spark.createDataFrame(
        [("a", 0, [BADGES[0][1]], 0, None, None)],
        "user_id string, total_points bigint, badges array<string>, workout_count bigint, last_day int, last_activity_date date")
    messages = workouts(spark, ("a", 1, 100))
    assert W.reward_state(messages, state).first().badges == [BADGES[0][1]]
    assert W.workout_progress(messages, state).first().new_badges == []


def test_notes(spark):
    events = E.detect_events(gold(spark, (20000, 0.8, 1), (10000, 0.1, 1), (0, 0.3, 0)))
    notes = {r.kind: (r.subject, r.body) for r in E.notifications(events, W.workout_progress(events)).collect()}
    assert notes["fraud"] == ("🚨 Fraud Detected!", "User: u0\nDay: 1\nSuspicious activity! Steps: 20000.0")
    assert notes["reward"] == (
        "Workout Reward Earned! 💪",
        "Great job u1!\n+100 points earned today\nTotal points: 100\nTotal workouts: 1\n🏅 New badge unlocked: First Step 🥉!")
    assert notes["reminder"] == (
        "Daily Activity Reminder 🏃",
        "Hey u2!\nNo steps recorded on day 3\nTime to get moving! 💪\nEven a short walk counts!")
