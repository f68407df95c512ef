"""The product's input tables, derived by Spark from the given ``events`` and ``orders`` tables.

Each adapter reads the whole table. Bad values, copies and gaps are placed by the content of the
rows (event type and the ``k`` property), so that every rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.config import DATE_PATTERN, FRAUD, INACTIVITY, TIME_PATTERN
from stridelake.operators import events as E
from stridelake.operators import gold as G
from stridelake.operators import silver as S

AS_OF = "2001-08-02 00:00:00"
SENT_AT = "2024-02-01 00:00:00"
SOURCE = "device_feed"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _intensity() -> Column:
    kinds = ("view", "click", "signup", "purchase", "error")
    chain = F
    for value, kind in enumerate(kinds):
        chain = chain.when(F.col("event_type") == kind, value)
    return chain


def _sleep(k: Column) -> Column:
    return F.when(k < 25, None).when(k < 50, 1).when(k < 75, 2).otherwise(3)


def minute_raw(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """Raw minute events as text: some without user, with unreadable time, negative steps or delivered twice."""
    k = F.col("k")
    row = F.struct(
        F.when(k == 97, None).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(k == 98, "bad").otherwise(F.date_format("ts", TIME_PATTERN)).alias("timestamp"),
        F.when(k == 99, "-1").otherwise(F.floor("value").cast("string")).alias("steps"),
        (F.floor("value") / 4.0).cast("string").alias("calories"),
        _intensity().cast("string").alias("intensity"),
        _sleep(k).cast("string").alias("sleep_value"),
    )
    sent = F.array_repeat(row, F.when(k < 10, 2).otherwise(1))
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(F.posexplode(sent).alias("copy", "row"), *carry)
        .select("row.*", F.concat(F.lit("2024-02-01 00:0"), F.col("copy").cast("string"), F.lit(":00")).alias("ingest_time"), *carry)
    )


def loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All raw events as JSON lines of three loads, by event type. The second load brings a ``heart_rate``; every load has
    lines that break off."""
    k, kind = F.col("k"), F.col("event_type")
    raw = ("user_id", "timestamp", "steps", "calories", "intensity", "sleep_value", "ingest_time")
    rows = minute_raw(spark, sf_dir, "event_type", "k")
    load = F.when(kind.isin("view", "click"), 0).when(kind.isin("signup", "purchase"), 1).otherwise(2)
    rate = F.when(load == 1, 60 + k)
    line = F.to_json(F.struct(*raw, rate.alias("heart_rate")))
    broken = F.when(k == 96, F.concat(F.lit("broken "), line)).otherwise(line)
    dealt = rows.select(load.alias("load"), broken.alias("value"))
    return [dealt.filter(F.col("load") == i).select("value") for i in range(3)]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.build_silver(minute_raw(spark, sf_dir))


def minute_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped rows without defects whose daily sums reach all thresholds."""
    steps = F.when(F.col("event_type") == "error", 0).otherwise(F.floor("value").cast("int") * 75)
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("timestamp"),
        steps.cast("int").alias("steps"),
        (F.floor("value") / 4.0).alias("calories"),
        _intensity().alias("intensity"),
        _sleep(_k()).alias("sleep_value"),
    )
    return S.enrich(S.mask(rows))


def gold_scaled(spark: SparkSession, sf_dir: str, full: bool = True) -> DataFrame:
    return G.gold_daily(minute_scaled(spark, sf_dir), full)


def _user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    steps = F.when(F.col("event_type") == "error", 0).otherwise(F.floor("value").cast("int") * 75)
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("Id"), F.to_date("ts").alias("date"))
        .agg(
            F.sum(steps).alias("StepTotal"),
            F.floor(F.sum(F.floor("value") / 4.0)).alias("Calories"),
            (25 * rows("purchase") + 15 * rows("click")).alias("VeryActiveMinutes"),
            (15 * rows("view")).alias("FairlyActiveMinutes"),
            (20 * rows("signup")).alias("LightlyActiveMinutes"),
            F.greatest(F.lit(0), 1440 - 250 * F.count(F.lit(1))).alias("SedentaryMinutes"),
            F.count_if(F.col("event_type") != "error").alias("readings"),
            F.count_if(F.col("event_type") != "signup").alias("moves"),
        )
        .withColumn("ActivityDay", F.date_format("date", DATE_PATTERN))
    )


def daily_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calories, steps, intensities). Calories lack days with errors only, intensities days with signups only."""
    days = _user_days(spark, sf_dir)
    return (
        days.filter("readings > 0").select("Id", "ActivityDay", "Calories"),
        days.select("Id", "ActivityDay", "StepTotal"),
        days.filter("moves > 0").select(
            "Id", "ActivityDay", "SedentaryMinutes", "LightlyActiveMinutes", "FairlyActiveMinutes", "VeryActiveMinutes"
        ),
    )


def hourly_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(steps, intensities) per user and hour. Hours with errors only have no intensity row."""
    hours = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("Id"), F.date_trunc("hour", "ts").alias("hour"))
        .agg(
            F.sum(F.floor("value")).alias("StepTotal"),
            F.sum(_intensity()).alias("TotalIntensity"),
            F.count_if(F.col("event_type") != "error").alias("readings"),
        )
        .withColumn("ActivityHour", F.date_format("hour", TIME_PATTERN))
    )
    return (
        hours.select("Id", "ActivityHour", "StepTotal"),
        hours.filter("readings > 0").select("Id", "ActivityHour", "TotalIntensity"),
    )


def minute_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(steps, calories, intensities, sleep). Each table misses some minutes; some minutes have two sleep logs."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("Id"),
        F.date_format("ts", TIME_PATTERN).alias("ActivityMinute"),
        F.floor("value").cast("string").alias("Steps"),
        (F.floor("value") / 20.0).cast("string").alias("Calories"),
        F.least(_intensity(), F.lit(3)).cast("string").alias("Intensity"),
        "event_id",
        _k().alias("k"),
        "event_type",
    )
    logs = F.when(F.col("k") >= 90, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sleep = (
        rows.filter("k >= 25")
        .withColumn("log", F.explode(logs))
        .select(
            "Id",
            F.col("ActivityMinute").alias("date"),
            F.when(F.col("log") == 1, 2).otherwise(_sleep(F.col("k"))).cast("string").alias("value"),
            (F.col("event_id") + F.col("log") * 1000000).cast("string").alias("logId"),
        )
    )
    return (
        rows.filter("k <> 11").select("Id", "ActivityMinute", "Steps"),
        rows.filter("k <> 12").select("Id", "ActivityMinute", "Calories"),
        rows.filter("k <> 13").select("Id", "ActivityMinute", "Intensity"),
        sleep,
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages: early ones delivered twice, alerts followed by an unknown type, some unreadable."""
    found = E.detect_events(gold_scaled(spark, sf_dir))
    kind, day = F.col("event_type"), F.col("day")
    sent_kinds = (
        F.when(kind == FRAUD, F.array(kind, F.lit("LEVEL_CHANGED")))
        .when(day <= 15, F.array(kind, kind))
        .otherwise(F.array(kind))
    )
    broken = (F.get_json_object("body", "$.event_type") == INACTIVITY) & (
        F.get_json_object("body", "$.day").cast("int") > 25
    )
    sent = E.to_messages(found.withColumn("event_type", F.explode(sent_kinds)), F.lit(SENT_AT).cast("timestamp_ntz"))
    return sent.withColumn("body", F.when(broken, F.concat(F.lit("broken "), "body")).otherwise(F.col("body")))


def change_rows(base: DataFrame) -> DataFrame:
    """One change per row of a silver table, by intensity: outdated update, late arrival, update, delete.

    ``base`` carries a ``seq`` column of 0.
    """
    kind, month = F.col("intensity"), F.expr("INTERVAL 30 DAYS")
    changed = base.filter(kind > 0).withColumns(
        {
            "timestamp": F.when(kind == 2, F.col("timestamp") + month).otherwise(F.col("timestamp")),
            "steps": F.when(kind == 1, 0).when(kind == 3, F.col("steps") + 1).otherwise(F.col("steps")),
            "seq": F.when(kind == 1, -1).when(kind == 3, 1).when(kind == 4, 2).otherwise(3),
            "operation_type": F.when(kind == 2, "INSERT").when(kind == 4, "DELETE").otherwise("UPDATE"),
        }
    )
    return S.enrich(changed)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` read as a listing of stored objects."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.when(status == "F", "bronze").when(status == "O", "silver").otherwise("gold").alias("store"),
        F.concat(
            F.when(status == "P", "predictions/").otherwise("minute_data/"), F.col("o_orderkey").cast("string")
        ).alias("path"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size_bytes"),
        F.col("o_orderdate").alias("last_modified"),
    )


def with_code(gold: DataFrame) -> DataFrame:
    """Gold rows with a raw class code that covers halves and codes outside the map."""
    return gold.withColumn("raw_prediction", (F.col("total_steps") % 50) / 10.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_code(gold_scaled(spark, sf_dir))
