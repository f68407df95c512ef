"""File streams: raw minute events, gold files as they arrive, queue messages, change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake import schemas
from stridelake.sources.drift import evolve_schema
from stridelake.sources.readers import with_corrupt


def bronze_stream(spark: SparkSession, path: str, schema_store: str, source: str = "device_feed",
                  pipeline: str = "minute_activity", max_files: int | None = None) -> DataFrame:
    """New JSON files as they arrive, with provenance columns.

    The schema is settled before the stream starts: the stored one plus columns found in newer
    files. A stream that is started again picks up new columns from then on.
    """
    reader = (
        spark.readStream.schema(with_corrupt(evolve_schema(spark, path, schema_store)))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
            "data_source": F.lit(source),
            "pipeline_name": F.lit(pipeline),
        }
    )


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a table: gold files as they arrive, or a change feed."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def arriving_gold(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Daily rows of gold files as they arrive, with the file they come from."""
    return parquet_stream(spark, path, schema, max_files).withColumn("source_file", F.col("_metadata.file_path"))


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message bodies, one per line, as ``sinks.write_messages`` leaves them."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(F.col("value").alias("body"))
