"""Bronze: every line that arrives is stored; what silver doesn't take is stored with the reasons.

A line is parsed with the columns known so far. Fields beyond them are rescued into a map by the same pass, and the batch
that brings them makes them columns at once: the running stream needs no restart, and no file's columns can slip between
a look at the schema and the listing of files. Columns are text, as all of bronze is.

Bronze, quarantine and silver are versioned tables that note the batch they hold. A batch that stopped half way is taken
up where it stopped: bronze rows are read back from the table, never parsed a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake import schemas
from stridelake.config import DEFAULTS, Thresholds
from stridelake.operators import rules as R
from stridelake.operators import silver as S
from stridelake.sources import versions
from stridelake.sources.readers import with_corrupt
from stridelake.streaming import stages, tables

RESCUED, BATCH, REASONS = "_rescued", "batch", "reasons"
PROVENANCE = ("ingestion_timestamp", "source_file", "data_source", "pipeline_name")
#: New columns that one batch may add, the most frequent first; fields beyond stay in the map.
MOST_NEW = 100
_NAME = r"^[A-Za-z][A-Za-z0-9_]*$"


def line_stream(spark: SparkSession, path: str, source: str = "device_feed", pipeline: str = "minute_activity",
                max_files: int | None = None) -> DataFrame:
    """Lines of new files as they arrive, plain or compressed, with their provenance."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        "value",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(source).alias("data_source"),
        F.lit(pipeline).alias("pipeline_name"),
    )


def parsed(lines: DataFrame, known: T.StructType) -> DataFrame:
    """Known columns, ``_rescued map<string,string>`` of all other fields (NULL if there are none), and the text of a line
    that is no JSON object. Blank lines are nothing."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    other = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~k.isin(*known.names))
    rows = lines.filter(F.trim("value") != "").select(
        F.from_json("value", with_corrupt(known), options).alias("_row"), F.when(F.size(other) > 0, other).alias(RESCUED),
        *[c for c in lines.columns if c != "value"])
    return rows.select("_row.*", *[c for c in rows.columns if c != "_row"])


def new_columns(rows: DataFrame, known: Sequence[str]) -> list[str]:
    """Fields among the rescued ones that can become columns: plain names that differ from all others beyond their case."""
    names = rows.select(F.explode(F.map_keys(RESCUED)).alias("name")).filter(F.col("name").rlike(_NAME))
    counts = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    taken = {c.lower() for c in (*known, *PROVENANCE, RESCUED, BATCH, REASONS, schemas.CORRUPT)}
    out = []
    for r in counts.orderBy(F.col("n").desc(), "name").limit(MOST_NEW).collect():
        if r["name"].lower() not in taken:
            taken.add(r["name"].lower())
            out.append(r["name"])
    return sorted(out)


def promoted(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rescued fields as columns of their own, and out of the map."""
    if not names:
        return rows
    rest = F.map_filter(RESCUED, lambda k, _: ~k.isin(*names))
    return rows.withColumns({n: F.col(RESCUED)[n] for n in names}).withColumn(RESCUED, F.when(F.size(rest) > 0, rest))


def known_columns(version: versions.Version | None, base: T.StructType = schemas.BRONZE_RAW) -> T.StructType:
    """Raw columns of the table, in the order in which they came; each notes the version that added it."""
    added = version.notes.get("columns", {}) if version is not None else {}
    return T.StructType([*base.fields, *[T.StructField(n, T.StringType()) for n in sorted(added, key=lambda n: (added[n], n))]])


def store_lines(lines: DataFrame, path: str, batch_id: int, base: T.StructType = schemas.BRONZE_RAW) -> DataFrame:
    """Commit a batch of lines to the bronze table and give its rows back as stored."""
    spark = lines.sparkSession
    mark = f"{tables._stream(spark)}-{batch_id}"
    version = versions.load(spark, path)
    if not tables._there(spark, path, batch_id):
        known = known_columns(version, base)
        rows = parsed(lines, known)
        names = new_columns(rows, known.names)
        number = (version.number if version else 0) + 1
        notes = {"applied": {tables._stream(spark): batch_id}, "columns": dict.fromkeys(names, number)}
        version = versions.append(promoted(rows, names).withColumn(BATCH, F.lit(mark)), path, [BATCH], version, notes)
    return versions.read(spark, path, version, [versions.partition_folder(spark, [BATCH], [mark])])


# --- what silver takes, and what it does not ---


def with_reasons(rows: DataFrame, rules: Sequence[R.Rule], late_before: Column | None = None) -> DataFrame:
    """Typed rows, the rows as they came in ``_raw``, and ``reasons``: why silver doesn't take one. Unreadable lines have
    that one reason; others each drop or fail rule they break, and ``late`` if their time lies before ``late_before``."""
    checked = S.typed(rows.withColumn("_raw", F.struct(*rows.columns)))
    reasons = [F.when(~r.passes(), r.name) for r in rules if r.action != "warn"]
    if late_before is not None:
        reasons.append(F.when(F.col("timestamp") < late_before, "late"))
    unreadable = F.col(schemas.CORRUPT).isNotNull()
    return checked.withColumn(REASONS, F.when(unreadable, F.array(F.lit("unreadable"))).otherwise(F.array_compact(F.array(*reasons))))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows for silver, raw rows with their reasons)."""
    good = checked.filter(F.size(REASONS) == 0).drop("_raw", REASONS, RESCUED, BATCH, schemas.CORRUPT)
    return good, checked.filter(F.size(REASONS) > 0).select("_raw.*", REASONS)


def medallion(root: str, rules: Sequence[R.Rule] = R.BATCH_RULES, delay: str | None = None, sequence_by: str = "ingest_time",
              t: Thresholds = DEFAULTS, hex_chars: int = 8, keep: int = 10) -> tables.Batch:
    """Lines to the tables ``bronze``, ``quarantine`` and ``silver`` below ``root``: each bronze row is in silver's input or in
    quarantine, never in both.

    With ``delay`` (an interval such as ``2 days``), rows that lie further behind the newest good row of all earlier batches
    are late. That time is noted with the quarantine table, so a restart and a repeated batch use the same one.
    """

    def each(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        stream = tables._stream(spark)
        rows = store_lines(lines, f"{root}/bronze", batch_id)
        held = versions.load(spark, f"{root}/quarantine")
        noted = held.notes["event_time"] if held is not None else {"before": None, "newest": None}
        repeated = held is not None and held.applied(stream) >= batch_id
        newest = noted["before" if repeated else "newest"]
        late = None if delay is None or newest is None else F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        good, bad = split(with_reasons(rows, rules, late))
        if not repeated:
            seen = good.agg(F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
            times = {"before": newest, "newest": max(filter(None, (newest, seen)), default=None)}
            versions.append(bad, f"{root}/quarantine", [BATCH], held, {"applied": {stream: batch_id}, "event_time": times})
        tables.silver_sink(f"{root}/silver", sequence_by)(stages.finished(good, t, hex_chars), batch_id)
        if (batch_id + 1) % keep == 0:
            for name in ("bronze", "quarantine"):
                versions.expire(spark, f"{root}/{name}", keep)

    return each
