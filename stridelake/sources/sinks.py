"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stridelake.config import FEATURES
from stridelake.schemas import WAREHOUSE_DDL
from stridelake.sources import versions

SILVER_PARTITIONS = ("year", "month", "day")
GOLD_PARTITIONS = ("year", "month")


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Replace the partitions that occur in ``df``, leave the others. Plain folders without versions, for one writer
    whose readers wait until it is done; ``versions.commit`` is for all others.

    Rows are dealt by partition; a day, however large, is split over several tasks and a small one shares a task with its
    neighbours, both by the sizes that the shuffle has measured. Within a file rows lie in cluster order.
    """
    order = [*partition_by, *cluster_by]
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_silver(df: DataFrame, path: str) -> None:
    write_partitions(df, path, SILVER_PARTITIONS, ["user_id", "timestamp"])


def write_gold(df: DataFrame, path: str) -> None:
    write_partitions(df, path, GOLD_PARTITIONS, ["user_id", "day"])


def managed_table(df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None) -> int:
    """Replace a catalog table by ``df`` and return its new version.

    Rows are committed as a version of ``path``, ``table_path`` of the name unless given; the catalog entry is a view of that version's folder and moves
    in one step, so readers see the old table or the new one. ``versions.feed_between`` gives what has changed.
    """
    spark = df.sparkSession
    path = path or table_path(spark, name)
    new = versions.commit(df, path, partition_by, None, versions.load(spark, path), cluster_by=[c for c in ("user_id",) if c in df.columns])
    columns = ", ".join(f"`{c}`" for c in new.schema.names if c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{_whole_commit(path, new)}`")
    return new.number


def table_path(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"


def _whole_commit(path: str, version: versions.Version) -> str:
    """Folder of a version whose rows all come from one commit."""
    commits = set(version.folders.values())
    if len(commits) != 1:
        raise ValueError(f"version {version.number} of {path} has no rows or is made of {len(commits)} commits")
    return f"{path}/data/{versions.COMMIT}={commits.pop()}"


# --- edges ---


def bronze_json(events: DataFrame, source: str, ingest_time: Column) -> DataFrame:
    """Valid merged minutes as JSON lines in ``value``; missing sleep stays an explicit null."""
    row = F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("timestamp").cast("string").alias("timestamp"),
        F.col("steps").try_cast("int").alias("steps"),
        F.col("calories").try_cast("double").alias("calories"),
        F.col("intensity").try_cast("int").alias("intensity"),
        F.col("sleep_value").try_cast("int").alias("sleep_value"),
        F.lit("minute_activity").alias("event_type"),
        F.lit(source).alias("source"),
        F.date_format(ingest_time, "yyyy-MM-dd HH:mm:ss").alias("ingest_time"),
    )
    return events.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(lines: DataFrame, path: str, gzip: bool = True) -> None:
    lines.select("value").write.mode("append").option("compression", "gzip" if gzip else "none").text(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Messages as text files, one body per line; for a broker use ``kafka_form`` and its sink."""
    messages.select(F.col("body").alias("value")).write.mode("append").text(path)


def kafka_form(messages: DataFrame) -> DataFrame:
    """Columns the Kafka sink expects; the user is the key, so one user's messages keep their order."""
    return messages.select(F.col("user_id").alias("key"), F.col("body").alias("value"))


def write_training_csv(data: DataFrame, path: str) -> None:
    """Header-less CSV, label first, one folder per side of the split."""
    for side in ("train", "test"):
        data.filter(F.col("split") == side).select("label", *FEATURES).write.mode("overwrite").option(
            "header", False
        ).csv(f"{path}/{side}")


def write_predictions(rows: DataFrame, path: str, run_date: str, source: str) -> None:
    """Prediction rows as JSON lines below the run date, and a one-row summary next to them."""
    rows.write.mode("overwrite").json(f"{path}/predictions/run_date={run_date}")
    summary = rows.agg(F.count(F.lit(1)).alias("total_users")).withColumns(
        {"run_date": F.lit(run_date), "source": F.lit(source)}
    )
    summary.write.mode("overwrite").json(f"{path}/summaries/run_date={run_date}")


# --- warehouse ---

WAREHOUSE_COLUMNS = (
    "user_id", "year", "month", "day", "total_steps", "total_calories", "active_minutes", "sleep_minutes", "avg_intensity",
    "max_steps_in_minute", "total_minutes_recorded", "anomaly_score", "activity_level",
)


def warehouse_rows(gold: DataFrame) -> DataFrame:
    """Gold in warehouse column order. Year and month make (user, day) unique over months."""
    return gold.select(*WAREHOUSE_COLUMNS)


def load_warehouse(spark: SparkSession, gold: DataFrame, table: str = "daily_summary", path: str | None = None) -> int:
    """Bulk load the reporting table and return its number of rows.

    The rows are committed as a new version, read back and counted, and only then does the catalog entry change its
    location, in one step: a stop at any point leaves the old table or the new one. The version before stays on disk for
    queries that still read it. ``path`` is where the versions lie, below the warehouse unless given.
    """
    path = path or table_path(spark, table)
    rows = gold.withColumn("processed_at", F.current_timestamp()).select(*WAREHOUSE_COLUMNS, "processed_at")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({WAREHOUSE_DDL}) USING parquet LOCATION '{path}/empty'")
    target = spark.table(table).schema
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in target.fields])
    expected = rows.observe(seen := Observation(), F.count(F.lit(1)).alias("n"))
    new = versions.commit(expected, path, (), None, versions.load(spark, path))
    written = versions.read(spark, path, new).count()
    if written != seen.get["n"]:
        raise RuntimeError(f"{table}: {seen.get['n']} rows were sent, {written} arrived")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_whole_commit(path, new)}'")
    spark.catalog.refreshTable(table)
    versions.expire(spark, path, keep=2)
    return written
