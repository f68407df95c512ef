"""Batch readers. Schemas are given, not inferred: inference would read all the data once more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake import schemas
from stridelake.sources import versions


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV. A file whose header differs from the schema is refused, not read into wrong columns."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_daily_csv(spark: SparkSession, calories: str, steps: str, intensities: str) -> tuple[DataFrame, ...]:
    return (
        read_csv(spark, calories, schemas.DAILY_CALORIES),
        read_csv(spark, steps, schemas.DAILY_STEPS),
        read_csv(spark, intensities, schemas.DAILY_INTENSITIES),
    )


def read_hourly_csv(spark: SparkSession, steps: str, intensities: str) -> tuple[DataFrame, ...]:
    return (
        read_csv(spark, steps, schemas.HOURLY_STEPS),
        read_csv(spark, intensities, schemas.HOURLY_INTENSITIES),
    )


def read_minute_csv(spark: SparkSession, steps: str, calories: str, intensities: str, sleep: str) -> tuple[DataFrame, ...]:
    """The four minute tables, all columns as text."""
    return (
        read_csv(spark, steps, schemas.MINUTE_STEPS),
        read_csv(spark, calories, schemas.MINUTE_CALORIES),
        read_csv(spark, intensities, schemas.MINUTE_INTENSITIES),
        read_csv(spark, sleep, schemas.MINUTE_SLEEP),
    )


def read_bronze_json(spark: SparkSession, path: str, schema: T.StructType = schemas.BRONZE_RAW) -> DataFrame:
    """One JSON object per line, plain or gzip. Lines that do not parse land in ``_corrupt_record``."""
    return (
        spark.read.schema(with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def with_corrupt(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name != schemas.CORRUPT]
    return T.StructType([*fields, T.StructField(schemas.CORRUPT, T.StringType())])


def read_event_lines(spark: SparkSession, path: str, schema: T.StructType = schemas.GOLD_DAILY) -> tuple[DataFrame, DataFrame]:
    """Gold rows kept as JSON lines: (rows that parse, the text of lines that do not).

    The lines are parsed from text, so a line is judged by its content whatever columns a query uses.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", with_corrupt(schema), options).alias("row"))
    bad = F.col(f"row.{schemas.CORRUPT}").isNotNull()
    return parsed.filter(~bad).select("row.*").drop(schemas.CORRUPT), parsed.filter(bad).select("value")


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """A Parquet table, its newest version if it has any. Columns, filters and partition filters reach the scan.

    A table in versions brings its schema along; a plain folder's is merged from its files.
    """
    df = versions.read(spark, path)
    if df is None:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def read_silver(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    return scan_parquet(spark, path, where=where)


def read_gold(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    return scan_parquet(spark, path, where=where)


def read_state(spark: SparkSession, path: str, user_id: str | None = None) -> DataFrame:
    """Reward profiles: all, or one user's. The user's hash bucket is worked out first, so one folder is listed and opened."""
    version = versions.load(spark, path)
    if version is None:
        return spark.createDataFrame([], schemas.REWARD_STATE)
    folders = None if user_id is None else _bucket_folders(spark, version, spark.range(1).select(F.lit(user_id).alias("user_id")))
    df = versions.read(spark, path, version, folders).select(*schemas.REWARD_STATE.names)
    return df if user_id is None else df.filter(F.col("user_id") == user_id)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def _bucket_folders(spark: SparkSession, version: versions.Version, users: DataFrame) -> list[str]:
    """Folders of the buckets that hold ``users``: at most one line for each bucket reaches the driver."""
    wanted = users.select(bucket_of(version.notes["layout"]["buckets"]).alias("bucket"))
    return versions.touched(wanted, ["bucket"])


def lookup_profiles(spark: SparkSession, path: str, users: DataFrame) -> DataFrame:
    """Reward profiles of the users in ``users (user_id)``: only their buckets are opened, then a semi join by user."""
    version = versions.load(spark, path)
    if version is None:
        return spark.createDataFrame([], schemas.REWARD_STATE)
    wanted = users.select(F.col("user_id").cast("string").alias("user_id"))
    rows = versions.read(spark, path, version, _bucket_folders(spark, version, wanted))
    return rows.select(*schemas.REWARD_STATE.names).join(wanted, "user_id", "left_semi")
