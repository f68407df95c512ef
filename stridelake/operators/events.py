"""Business events on user-days, their messages, and the texts sent to users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, FRAUD, FRAUD_SUBJECT, INACTIVITY, REMINDER_SUBJECT, REWARD_SUBJECT, WORKOUT
from stridelake.config import Thresholds
from stridelake.functions import columns as X
from stridelake.schemas import CORRUPT, MESSAGE

NUMERIC_INPUTS = ("total_steps", "anomaly_score", "active_minutes")


def _number(gold: DataFrame, name: str) -> Column:
    return F.col(name).cast("double") if name in gold.columns else F.lit(0.0)


def split_detectable(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the rules can judge, rows with a NULL input). A NULL never counts as an idle day."""
    complete = F.lit(True)
    for name in NUMERIC_INPUTS:
        complete = complete & _number(gold, name).isNotNull()
    return gold.filter(complete), gold.filter(~complete)


def business_event(steps: Column, score: Column, t: Thresholds = DEFAULTS) -> Column:
    """Struct (event_type, message, priority, points) of the first rule that matches, else NULL."""

    def event(kind: str, message: Column, priority: str, points: int) -> Column:
        return F.struct(
            F.lit(kind).alias("event_type"),
            message.alias("message"),
            F.lit(priority).alias("priority"),
            F.lit(points).alias("points"),
        )

    shown = X.float_text(steps)
    return (
        F.when(X.is_fraud(score, t), event(FRAUD, F.concat(F.lit("Suspicious activity! Steps: "), shown), "HIGH", 0))
        .when(
            steps >= t.workout_steps,
            event(WORKOUT, F.concat(F.lit("Amazing! You hit "), shown, F.lit(" steps today!")), "LOW", t.workout_points),
        )
        .when(steps == 0, event(INACTIVITY, F.lit("No steps today — time to move!"), "MEDIUM", 0))
    )


def detect_events(gold: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """At most one event per user-day. Streams too."""
    judged, _ = split_detectable(gold)
    return (
        judged.select(
            F.coalesce("user_id", F.lit("UNKNOWN")).alias("user_id"),
            F.coalesce("day", F.lit(0)).alias("day"),
            F.make_date("year", "month", "day").alias("activity_date"),
            business_event(_number(gold, "total_steps"), _number(gold, "anomaly_score"), t).alias("event"),
        )
        .filter(F.col("event").isNotNull())
        .select("user_id", "day", "activity_date", "event.*")
    )


def to_messages(events: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """Queue form: ``user_id`` as the message key, the event as JSON text in ``body``. Streams too."""
    sent = F.date_format(F.current_timestamp() if sent_at is None else sent_at, "yyyy-MM-dd HH:mm:ss")
    body = F.to_json(
        F.struct("user_id", "day", "activity_date", "event_type", "message", "priority", "points",
                 sent.alias("timestamp"))
    )
    return events.select("user_id", body.alias("body"))


def _day_before(sent: Column, day: Column) -> Column:
    """The last date with this day of the month up to the sending date; the sending date if no month has the day."""
    this = F.trunc(sent, "month")
    before = F.add_months(this, -1)
    month = (
        F.when(day <= F.dayofmonth(sent), this)
        .when(day <= F.dayofmonth(F.last_day(before)), before)
        .otherwise(F.add_months(before, -1))  # of two months in a row one has 31 days
    )
    return F.when(day.between(1, 31), F.date_add(month, day - 1)).otherwise(sent)


def decode_messages(df: DataFrame) -> DataFrame:
    """Read message bodies. Absent fields get defaults; a body that does not parse is marked failed.

    A body counts as failed if it is no JSON object or if a field has the wrong type. Without an activity date,
    a message is dated by its day number and the time it was sent, so that months do not mix.
    """
    parsed = F.from_json("body", MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = df.select("body", parsed.alias("m"))
    failed = F.col("body").isNull() | F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()

    def field(name: str, default: Column) -> Column:
        return F.when(~F.col("failed"), F.coalesce(F.col(f"m.{name}"), default)).alias(name)

    sent = F.to_date(F.try_to_timestamp(F.col("m.timestamp")))
    dated = _day_before(sent, F.coalesce(F.col("m.day"), F.lit(0)))
    return rows.withColumn("failed", failed).select(
        field("user_id", F.lit("UNKNOWN")),
        field("day", F.lit(0)),
        F.when(~F.col("failed"), F.coalesce(F.col("m.activity_date"), dated)).alias("activity_date"),
        field("event_type", F.lit("")),
        F.when(~F.col("failed"), F.col("m.message")).alias("message"),
        field("points", F.lit(0)),
        "failed",
        F.when(F.col("failed"), F.col("body")).alias("failed_body"),
    )


def with_route(messages: DataFrame) -> DataFrame:
    """Where each decoded message goes: reward, remind, skip (already alerted), log (unknown), failed."""
    kind = F.col("event_type")
    return messages.withColumn(
        "route",
        F.when(F.col("failed"), "failed")
        .when(kind == WORKOUT, "reward")
        .when(kind == INACTIVITY, "remind")
        .when(kind == FRAUD, "skip")
        .otherwise("log"),
    )


def route(messages: DataFrame) -> dict[str, DataFrame]:
    """The routed messages as one frame per destination."""
    routed = with_route(messages)
    return {name: routed.filter(F.col("route") == name).drop("route")
            for name in ("reward", "remind", "skip", "log", "failed")}


# --- texts ---

def event_texts(events: DataFrame) -> DataFrame:
    """Alerts for suspicious days and reminders for idle ones, in one pass over the events. Streams too."""
    kind, day = F.col("event_type"), F.col("day").cast("string")
    alert = F.concat(F.lit("User: "), "user_id", F.lit("\nDay: "), day, F.lit("\n"), "message")
    reminder = F.concat(
        F.lit("Hey "), "user_id", F.lit("!\nNo steps recorded on day "), day,
        F.lit("\nTime to get moving! 💪\nEven a short walk counts!"),
    )
    return events.filter(kind.isin(FRAUD, INACTIVITY)).select(
        "user_id",
        "activity_date",
        F.when(kind == FRAUD, "fraud").otherwise("reminder").alias("kind"),
        F.when(kind == FRAUD, FRAUD_SUBJECT).otherwise(REMINDER_SUBJECT).alias("subject"),
        F.when(kind == FRAUD, alert).otherwise(reminder).alias("body"),
    )


def reward_notes(progress: DataFrame) -> DataFrame:
    """One note per rewarded day, from ``rewards.workout_progress``."""
    badge_line = F.when(
        F.size("new_badges") > 0,
        F.concat(F.lit("\n🏅 New badge unlocked: "), F.concat_ws(", ", "new_badges"), F.lit("!")),
    ).otherwise("")
    body = F.concat(
        F.lit("Great job "), "user_id", F.lit("!\n+"), F.col("points").cast("string"),
        F.lit(" points earned today\nTotal points: "), F.col("running_points").cast("string"),
        F.lit("\nTotal workouts: "), F.col("workout_number").cast("string"), badge_line,
    )
    return progress.select(
        "user_id", "activity_date", F.lit("reward").alias("kind"), F.lit(REWARD_SUBJECT).alias("subject"),
        body.alias("body"),
    )


def notifications(events: DataFrame, progress: DataFrame) -> DataFrame:
    """All texts of a run: alerts and reminders from the events, notes from the reward progress."""
    return event_texts(events).unionByName(reward_notes(progress))


def event_counts(validated: DataFrame, gold: DataFrame, messages: DataFrame) -> DataFrame:
    """Counters of the three steps: events validated, user-days judged, messages processed."""

    def lines(counts: DataFrame, step: str, names: list[str]) -> DataFrame:
        rows = [F.struct(F.lit(step).alias("step"), F.lit(n).alias("outcome"), F.col(n).alias("row_count")) for n in names]
        return counts.select(F.inline(F.array(*rows)))

    ingest = validated.agg(
        F.count_if(F.size("errors") == 0).alias("valid"), F.count_if(F.size("errors") > 0).alias("invalid")
    )
    steps, score = _number(gold, "total_steps"), _number(gold, "anomaly_score")
    judged = steps.isNotNull() & score.isNotNull() & _number(gold, "active_minutes").isNotNull()
    event = business_event(steps, score)
    detect = gold.agg(
        F.count_if(judged & event.isNotNull()).alias("sent"),
        F.count_if(judged & event.isNull()).alias("skipped"),
        F.count_if(~judged).alias("unreadable"),
    )
    reward = messages.agg(
        F.count_if(~F.col("failed")).alias("processed"), F.count_if(F.col("failed")).alias("failed")
    )
    return (
        lines(ingest, "ingest", ["valid", "invalid"])
        .unionByName(lines(detect, "detect", ["sent", "skipped", "unreadable"]))
        .unionByName(lines(reward, "reward", ["processed", "failed"]))
    )
