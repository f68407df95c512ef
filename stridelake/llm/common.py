"""Shared steps: stored tables, row handles and running totals without a single-task window."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridelake.session import remove, scratch

#: Words are runs of other characters than these (ASCII white space).
SPACE = " \t\n\x0b\f\r"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


#: Removes the shuffle files of a query as soon as it has ended, not when its plan is collected some time later.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(spark: SparkSession, arrow_rows: int | None) -> Iterator[None]:
    wanted = {_CLEAN: "true"} | ({_ROWS: str(arrow_rows)} if arrow_rows else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later readers repeat nothing, and no executor owns it. What
    was shuffled for it is given up then, so a chain of steps holds the files of one step at a time.

    ``arrow_rows`` bounds the rows that a Python worker gets at a time, for steps on whole texts.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with _settings(spark, arrow_rows):
        df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    return _noted(rows, path)


def _noted(rows: DataFrame, path: str) -> DataFrame:
    rows._lies_in = path
    if _under_way:
        _under_way[-1].append(rows)
    return rows


def forget(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read any more."""
    for table in tables:
        remove(table.sparkSession, table._lies_in)


#: Tables stored so far by the steps that are under way, innermost last.
_under_way: list[list[DataFrame]] = []


@contextmanager
def steps() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """For an operator whose result is a stored table: what else it stores on the way is removed at its end, the tables
    that it hands to the given function stay (for whoever has called it)."""
    _under_way.append([])
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        own = _under_way.pop()
        forget(*[t for t in own if all(t is not k for k in kept)])
        if _under_way:
            _under_way[-1].extend(kept)


def bucketed(df: DataFrame, name: str, by: str, buckets: int, arrow_rows: int | None = None) -> DataFrame:
    """``stored`` in buckets of ``by``: a step that groups or joins by it reads the table where it lies, without a shuffle.
    The catalog entry that Spark's writer wants is given up at once; the rows stay."""
    spark = df.sparkSession
    path, table = scratch(spark, name), f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    with _settings(spark, arrow_rows):
        df.write.bucketBy(buckets, by).option("path", path).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return _noted(rows, path)


def give_back() -> None:
    """At the end of a task's large arrays: memory that is free again goes to the system. The Python worker stays for tasks of
    other steps, and what it holds on to would be added to theirs."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def word_count(text: Column) -> Column:
    """Words of a text, 0 for NULL. A single blank as separator spares the regular expression engine."""
    blank = F.translate(text, SPACE, " " * len(SPACE))
    return F.coalesce(F.size(F.array_remove(F.split(blank, " ", -1), "")), F.lit(0)).cast("long")


def laid_out(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted by ``order`` over range partitions and stored, with each row's place: ``_part``, ``_row``.

    (``_part``, ``_row``) is a unique row handle that sorts as ``order`` does.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    return stored(placed, name)


def running(placed: DataFrame, value: str | None, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Exclusive running total of ``value`` (or of rows) in the order of ``laid_out``, for each value of ``by``.

    A window within each stored partition plus the totals of the partitions before it: no task sees more than one
    partition's rows or one line per partition.
    """
    amount = F.lit(1) if value is None else F.col(value)
    keys = list(by)
    per = placed.groupBy(*keys, "_part").agg(F.sum(amount).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy(*keys, "_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    counted = placed.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    match = [F.col("_part") == F.col("_p")] + [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on = match[0]
    for m in match[1:]:
        on = on & m
    return (
        counted.join(base, on)
        .withColumn(out, (F.col("_in") + F.col("_base")).cast("long"))
        .drop("_in", "_base", "_p", *[f"_k{i}" for i in range(len(keys))])
    )
