"""Tables in versions: immutable folders of rows, and one small manifest a version that names the folders in force.

Below a table's path::

    data/_commit=<id>/<partition folders>/*.parquet    never touched again once a version names it
    _versions/<number>.json                            one manifest a version

A commit writes its rows to a new folder and then publishes the next manifest by a rename that fails if the number is
taken. Until then readers see the version before, and a stop in between leaves an unnamed folder that ``expire`` removes.
A manifest holds one line for each partition (the commit its rows are in), the schema, and small notes: which batch of
which stream is in, up to which version of a source the table has followed it. So a repeated batch is known by the table
itself, and rows and notes can't disagree. One writer at a time; a second one gets ``Conflict``, never a mixed table.

Readers list only the folders they need and take the schema from the manifest, so no footer is read to plan a scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.operators.change import DELETE, cdc_apply, snapshot_diff

COMMIT = "_commit"


class Conflict(RuntimeError):
    """Another writer has published the version this commit was based on."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: dict[str, str]  # partition folder, such as year=2024/month=1, to the commit that holds its rows
    notes: dict = field(default_factory=dict)

    def applied(self, stream: str) -> int:
        """Last batch of ``stream`` that is in the table, -1 for none."""
        return self.notes.get("applied", {}).get(stream, -1)

    def followed(self, source: str) -> int:
        """Version of ``source`` that the table has followed up to, 0 for none."""
        return self.notes.get("followed", {}).get(source, 0)


# --- files ---


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    root, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def _publish(spark: SparkSession, path: str, version: Version) -> None:
    """The manifest appears whole or not at all, and never in place of another one."""
    body = {"schema": json.loads(version.schema.json()), "partition_by": list(version.partition_by), "folders": version.folders, "notes": version.notes}
    temporary, fs = _files(spark, f"{path}/_versions/.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(body, sort_keys=True).encode()))
    out.close()
    target, _ = _files(spark, f"{path}/_versions/{version.number}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(temporary, target, no_options)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise Conflict(f"version {version.number} of {path} is there already") from error
        raise


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Published versions, ascending."""
    found = _names(spark, f"{path}/_versions")
    return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("."))


def load(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """One version, the newest unless given; None for a path without versions and for version 0."""
    if number is None:
        known = numbers(spark, path)
        number = known[-1] if known else 0
    if number == 0:
        return None
    target, fs = _files(spark, f"{path}/_versions/{number}.json")
    stream = fs.open(target)
    body = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return Version(number, T.StructType.fromJson(body["schema"]), tuple(body["partition_by"]), body["folders"], body["notes"])


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(numbers(spark, path))


# --- reading ---


def partition_folder(spark: SparkSession, partition_by: Sequence[str], values: Sequence) -> str:
    """The folder Spark's writer gives to these partition values."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(names.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(partition_by, values))


def read(spark: SparkSession, path: str, version: Version | int | None = None, only: Iterable[str] | None = None) -> DataFrame | None:
    """Rows of a version (the newest unless given), all or those of the partition folders in ``only``."""
    if not isinstance(version, Version):
        version = load(spark, path, version)
    if version is None:
        return None
    wanted = version.folders if only is None else [k for k in dict.fromkeys(only) if k in version.folders]
    if not wanted:
        return spark.createDataFrame([], version.schema)
    paths = [f"{path}/data/{COMMIT}={version.folders[k]}/{k}".rstrip("/") for k in wanted]
    rows = spark.read.schema(version.schema).option("basePath", f"{path}/data").parquet(*paths)
    return rows.select(*version.schema.names)


# --- writing ---


def _merged_schema(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """``known`` and then the columns only ``new`` has. A column keeps its type."""
    if known is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in new.fields])
    types = {f.name: f.dataType for f in known.fields}
    for f in new.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*known.fields, *[T.StructField(f.name, f.dataType) for f in new.fields if f.name not in types]])


def write_folders(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Parquet folders whose files are of even size: small partitions share a task, a large one is split over several,
    both by the sizes that the shuffle has measured (no sampling pass over the input)."""
    order = [*partition_by, *[c for c in cluster_by if c not in partition_by]]
    rows = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def commit(df: DataFrame, path: str, partition_by: Sequence[str], replace: Iterable[str] | None = (), base: Version | None = None,
           notes: Mapping[str, Mapping] | None = None, cluster_by: Sequence[str] = ()) -> Version:
    """Publish ``base`` with the partitions in ``replace`` (None: all) given up and those of ``df`` added.

    A partition that ``df`` has rows of and that isn't replaced would hold them twice or lose the old ones, so it must be
    in ``replace`` if ``base`` has it. ``notes`` are merged into those of ``base``.
    """
    spark = df.sparkSession
    schema = _merged_schema(base.schema if base else None, df.schema)
    mark = f"{(base.number if base else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/data/{COMMIT}={mark}"
    write_folders(df, folder, partition_by, cluster_by)
    if partition_by:
        pattern, fs = _files(spark, folder + "".join(f"/{c}=*" for c in partition_by))
        written = ["/".join(s.getPath().toString().split("/")[-len(partition_by):]) for s in fs.globStatus(pattern) or []]
    else:
        written = [""]
    kept = {} if base is None or replace is None else {k: v for k, v in base.folders.items() if k not in set(replace)}
    if twice := [k for k in written if k in kept]:
        raise ValueError(f"{path}: {twice[0]} is written but not replaced")
    merged = dict(base.notes) if base else {}
    for name, values in (notes or {}).items():
        merged[name] = {**merged.get(name, {}), **values}
    new = Version((base.number if base else 0) + 1, schema, tuple(partition_by), kept | dict.fromkeys(written, mark), merged)
    _publish(spark, path, new)
    return new


def note(spark: SparkSession, path: str, base: Version, notes: Mapping[str, Mapping]) -> Version:
    """A version with the rows of ``base`` and more notes: what a batch without changes leaves."""
    merged = dict(base.notes)
    for name, values in notes.items():
        merged[name] = {**merged.get(name, {}), **values}
    new = Version(base.number + 1, base.schema, base.partition_by, base.folders, merged)
    _publish(spark, path, new)
    return new


def touched(changes: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Partition folders that occur in ``changes``: at most one line for each folder reaches the driver."""
    if not partition_by:
        return [""]
    spark = changes.sparkSession
    return [partition_folder(spark, partition_by, r) for r in changes.select(*partition_by).distinct().collect()]


def upsert(changes: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], sequence_by: str, ties: Sequence[str] = (),
           delete_when: str = DELETE, notes: Mapping[str, Mapping] | None = None, cluster_by: Sequence[str] = ()) -> Version | None:
    """Merge ``changes`` by key; only the folders they touch are read, and only their rows written anew.

    The partition columns must follow from the key, so a key never moves. A partition left without rows goes.
    """
    spark = changes.sparkSession
    base = load(spark, path)
    if base is not None:
        _merged_schema(base.schema, changes.drop("operation_type").schema)  # a union would cast without a word
    folders = touched(changes, partition_by)
    if not folders:
        return note(spark, path, base, notes) if base is not None and notes else base
    current = read(spark, path, base, folders)
    if current is None:
        current = changes.filter(F.lit(False)).drop("operation_type")
    merged = cdc_apply(current, changes, keys, sequence_by, delete_when, ties=ties)
    return commit(merged, path, partition_by, folders, base, notes, cluster_by or keys)


def append(rows: DataFrame, path: str, partition_by: Sequence[str], base: Version | None, notes: Mapping[str, Mapping] | None = None) -> Version:
    """Add rows in partitions of their own, such as one for each batch."""
    return commit(rows, path, partition_by, (), base, notes)


# --- changes ---


def changed_folders(old: Version | None, new: Version | None) -> list[str]:
    before, after = (v.folders if v else {} for v in (old, new))
    return [k for k in dict.fromkeys([*before, *after]) if before.get(k) != after.get(k)]


def feed_between(spark: SparkSession, path: str, keys: Sequence[str], old: int, new: int | None = None) -> DataFrame:
    """Change feed from version ``old`` (0: the empty table) to ``new`` (the newest): only folders that differ are read."""
    v1, v0 = load(spark, path, new), load(spark, path, old)
    if v1 is None:
        raise ValueError(f"{path} has no versions")
    folders = changed_folders(v0, v1)
    after = read(spark, path, v1, folders)
    before = read(spark, path, v0, folders) if v0 is not None else after.filter(F.lit(False))
    return snapshot_diff(before, after, keys)


def expire(spark: SparkSession, path: str, keep: int = 10) -> list[str]:
    """Remove manifests but the newest ``keep``, and commits that none of those names. To be run by the writer."""
    known = numbers(spark, path)
    kept = known[-keep:]
    for number in known[: -keep or None]:
        if number not in kept:
            target, fs = _files(spark, f"{path}/_versions/{number}.json")
            fs.delete(target, False)
    named = {c for n in kept for c in load(spark, path, n).folders.values()}
    gone = [n for n in _names(spark, f"{path}/data") if n.startswith(f"{COMMIT}=") and n.removeprefix(f"{COMMIT}=") not in named]
    for name in gone:
        target, fs = _files(spark, f"{path}/data/{name}")
        fs.delete(target, True)
    return gone
