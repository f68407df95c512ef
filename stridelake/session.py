"""Session settings the package relies on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def pin(spark: SparkSession) -> SparkSession:
    """Device times carry no zone, so they are read and kept as UTC wall-clock times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder, else a folder
    in the warehouse. The same rule holds for every master, and the session is not changed."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared").rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder. Who asks for it removes it when its readers are done."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder, so that several readers do not repeat the work.

    The written table outlives the executors that made it, and later steps still prune its columns.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``cut`` for work that ends here: what it has written is removed on the way out."""
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        paths.append(scratch(spark, "cut"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            remove(spark, path)
