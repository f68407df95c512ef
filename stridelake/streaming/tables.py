"""Streams into tables. Every sink gives the same table when a micro-batch is delivered again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stridelake.config import DEFAULTS, WORKOUT, Thresholds
from stridelake.operators import ml as M
from stridelake.operators import rewards as W
from stridelake.operators import rules as R
from stridelake.operators import silver as S
from stridelake.operators.events import decode_messages, reward_notes
from stridelake.operators.silver import MEASURES
from stridelake.schemas import REWARD_STATE
from stridelake.sources import sinks, versions
from stridelake.sources.readers import bucket_of
from stridelake.streaming import stages

Batch = Callable[[DataFrame, int], None]


def run(df: DataFrame, checkpoint: str, each: Batch, mode: str = "append", continuous: str | None = None) -> StreamingQuery:
    """Start the stream: all data there is and stop, or every ``continuous`` interval.

    Sinks look at a batch more than once, so it is kept until the sink is done with it.
    """

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            each(batch, batch_id)
        finally:
            batch.unpersist()

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
        .foreachBatch(kept).start()
    )


def _stream(spark: SparkSession) -> str:
    """Id of the running stream; it stays the same when the stream restarts from its checkpoint. Outside a stream the caller
    numbers the batches, and a number counts once for each table."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _there(spark: SparkSession, path: str, batch_id: int) -> bool:
    """TRUE if the table holds this batch of the running stream already."""
    version = versions.load(spark, path)
    return version is not None and version.applied(_stream(spark)) >= batch_id


def upsert_to(path: str, keys: Sequence[str], partition_by: Sequence[str], sequence_by: str, ties: Sequence[str] = (),
              keep: int = 10) -> Batch:
    """Merge each batch into the table by key; the highest sequence wins. The batch's number is committed with its rows.

    The newest ``keep`` versions stay; who follows the table must not fall further behind.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _there(spark, path, batch_id):
            return
        own = [c for c in ties if c in batch.columns]
        done = versions.upsert(batch, path, keys, partition_by, sequence_by, own, notes={"applied": {_stream(spark): batch_id}})
        if done is not None and done.number % keep == 0:
            versions.expire(spark, path, keep)

    return each


def run_to_table(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str],
                 sequence_by: str, mode: str = "append") -> StreamingQuery:
    return run(df, checkpoint, upsert_to(path, keys, partition_by, sequence_by), mode)


def silver_sink(path: str, sequence_by: str = "processed_at", then: Callable[[SparkSession], None] | None = None) -> Batch:
    """Merge each batch into silver; copies are settled as in the batch dedup. ``then`` runs after each commit, such as
    ``follow.gold``; what it misses by a stop it takes up at the next batch. The change feed is ``versions.feed_between``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_to(path, S.merge_keys(batch.columns), sinks.SILVER_PARTITIONS, sequence_by, MEASURES)(batch, batch_id)
        if then is not None:
            then(batch.sparkSession)

    return each


def _finished(spark: SparkSession, path: str) -> bool:
    marker, fs = versions._files(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def counted(path: str, rules: Sequence[R.Rule], then: Batch, t: Thresholds = DEFAULTS, hex_chars: int = 8) -> Batch:
    """For a stream of raw rows: store each batch's expectation counts, then hand its silver rows to ``then``.

    Counts lie in a folder for each batch, which a repeated batch writes anew, so the totals count every batch once
    however long the stream runs. They are stored before a fail rule can stop the batch.
    """

    def each(raw: DataFrame, batch_id: int) -> None:
        mark = f"{_stream(raw.sparkSession)}-{batch_id}"
        R.rules_report(S.typed(raw), rules).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={mark}")
        then(stages.silver_stream(raw, rules, t=t, hex_chars=hex_chars), batch_id)

    return each


def expectation_totals(spark: SparkSession, path: str) -> DataFrame:
    """Rows seen and rows that broke each rule, over all batches."""
    totals = spark.read.parquet(path).groupBy("rule", "action")
    return totals.agg(F.sum("total_rows").alias("total_rows"), F.sum("failed_rows").alias("failed_rows"))


def reward_sink(state_path: str, log_path: str, notes_path: str | None = None, buckets: int = 64, keep: int = 10) -> Batch:
    """Add the rewards of each message batch to the profiles, once per user and day.

    ``log_path`` is a table of the user-days that have been rewarded, and by which batch. Messages logged by another batch
    are left out; those logged by this very batch are not, so a batch that stopped between log and profiles sees the same
    messages again, and profiles that hold the batch already stay as they are. Profiles lie in hash buckets of the user;
    only buckets with news are rewritten. The number of buckets is noted with the profiles, and another one is refused:
    users would get a second profile. Both tables keep their newest ``keep`` versions, so the number of files follows the
    number of days and buckets, not that of batches.

    A keyed stateful operator with a time limit would forget user-days that may still be delivered again, and in Python it
    runs each row through a worker; the log table holds them all and is read by day.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"{_stream(spark)}-{batch_id}"
        base = versions.load(spark, state_path)
        if base is not None and base.notes["layout"]["buckets"] != buckets:
            raise ValueError(f"{state_path} is kept in {base.notes['layout']['buckets']} buckets, not {buckets}")
        fresh = _log_new_workouts(batch, log_path, batch_id)
        if _there(spark, state_path, batch_id):
            return
        fresh = fresh.withColumn("bucket", bucket_of(buckets))
        folders = versions.touched(fresh, ["bucket"])
        state = versions.read(spark, state_path, base, folders) if base is not None else spark.createDataFrame([], REWARD_STATE)
        if notes_path is not None and not _finished(spark, f"{notes_path}/batch={mark}"):
            notes = reward_notes(W.workout_progress(fresh, state))
            notes.write.mode("overwrite").json(f"{notes_path}/batch={mark}")
        after = W.reward_state(fresh, state.select(*REWARD_STATE.names)).withColumn("bucket", bucket_of(buckets))
        done = versions.commit(after, state_path, ["bucket"], folders, base,
                               {"applied": {_stream(spark): batch_id}, "layout": {"buckets": buckets}}, ["user_id"])
        if done.number % keep == 0:
            versions.expire(spark, state_path, keep)
            versions.expire(spark, log_path, keep)

    return each


_NO_DATE = "1970-01-01"


def _log_new_workouts(batch: DataFrame, log_path: str, batch_id: int) -> DataFrame:
    """Log the workouts of this batch that no other batch has logged, and read them back."""
    spark = batch.sparkSession
    mark = f"{_stream(spark)}-{batch_id}"
    no_date = F.lit(_NO_DATE).cast("date")
    news = W.workouts(decode_messages(batch).filter(~F.col("failed"))).withColumn(
        "activity_date", F.coalesce("activity_date", no_date)
    )
    base = versions.load(spark, log_path)
    folders = versions.touched(news, ["activity_date"])
    if not _there(spark, log_path, batch_id):
        rows = news.withColumn("batch", F.lit(mark))
        if base is not None:
            logged = versions.read(spark, log_path, base, folders).filter(F.col("batch") != mark)
            rows = logged.unionByName(rows.join(logged, ["user_id", "activity_date", "day"], "left_anti"))
        base = versions.commit(rows, log_path, ["activity_date"], folders, base, {"applied": {_stream(spark): batch_id}}, ["user_id"])
    return versions.read(spark, log_path, base, folders).filter(F.col("batch") == mark).select(
        "user_id",
        F.nullif(F.col("activity_date"), no_date).alias("activity_date"),
        "day",
        "points",
        F.lit(WORKOUT).alias("event_type"),
    )


# --- scoring on arrival ---

PREDICTION_KEYS = ("model_version", "user_id", "date")
PREDICTION_PARTITIONS = ("model_version", "year", "month")


def scoring_sink(path: str, score: Callable[[DataFrame], DataFrame], model_version: str, keep: int = 10) -> Batch:
    """Score daily rows as their files arrive, each file once for each model version.

    Batches carry the file in ``source_file`` (``sources.arriving_gold``); ``score`` adds ``raw_prediction``. Files are known
    by the predictions they have left in the months they touch, so a file that is delivered again, even to a new
    checkpoint, is not scored again; a later file's row for the same user and day replaces the earlier one.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("model_version", F.lit(model_version))
        base = versions.load(spark, path)
        number = base.number if base is not None else 0
        if base is not None:
            if base.applied(_stream(spark)) >= batch_id:
                return
            known = versions.read(spark, path, base, versions.touched(rows, PREDICTION_PARTITIONS))
            rows = rows.join(known.select("source_file").distinct(), "source_file", "left_anti")
        carry = ("source_file", *PREDICTION_PARTITIONS)
        found = M.predictions(score(rows), carry=carry).withColumns({"run": F.lit(number + 1), "scored_at": F.current_timestamp()})
        done = versions.upsert(found, path, PREDICTION_KEYS, PREDICTION_PARTITIONS, "run", notes={"applied": {_stream(spark): batch_id}})
        if done is not None and done.number % keep == 0:
            versions.expire(spark, path, keep)

    return each
