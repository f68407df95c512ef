"""Schema drift of raw JSON: new columns are found, added at the end and remembered."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake import schemas

_STORED = "version int, stored_at string, schema string"


def load_schema(spark: SparkSession, store: str) -> tuple[int, str | None, T.StructType | None]:
    """(version, time stored, schema) of the newest entry; (0, None, None) for a new store."""
    try:
        entries = spark.read.schema(_STORED).json(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None, None
    newest = entries.agg(F.max(F.struct("version", "stored_at", "schema")).alias("e")).select("e.*").first()
    if newest is None or newest.version is None:
        return 0, None, None
    return newest.version, newest.stored_at, T.StructType.fromJson(json.loads(newest.schema))


def merge_schema(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with columns only ``found`` has; raw columns are text whatever they look like."""
    names = set(known.names)
    extra = [T.StructField(f.name, T.StringType()) for f in found.fields
             if f.name not in names and f.name != schemas.CORRUPT]
    return T.StructType([*known.fields, *extra])


def evolve_schema(spark: SparkSession, path: str, store: str, base: T.StructType = schemas.BRONZE_RAW) -> T.StructType:
    """Schema to read ``path`` with.

    Only files that arrived since the last stored schema are looked at, so the cost follows the new
    data. A changed schema is appended to the store as a new version; nothing is overwritten.
    """
    version, stored_at, known = load_schema(spark, store)
    known = known or base
    reader = spark.read.option("primitivesAsString", True)
    if stored_at is not None:
        reader = reader.option("modifiedAfter", stored_at).option("timeZone", "UTC")
    now = spark.sql("SELECT date_format(to_utc_timestamp(now(), current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss\")").first()[0]
    try:
        found = reader.json(path).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        found = T.StructType([])
    merged = merge_schema(known, found)
    if merged != known or version == 0:
        entry = spark.createDataFrame([(version + 1, now, merged.json())], _STORED)
        entry.coalesce(1).write.mode("append").json(store)
    return merged
