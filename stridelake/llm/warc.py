"""WARC archives: written by Spark's text writer, read by a Python data source.

A record ends with two line ends, which is the text writer's line separator here, so any file system that Spark writes
to takes archives, and a lost task is repeated by the commit protocol. The reader plans one partition for a share of
the files, parses a record's headers first, and skips the block of a record that the pushed filters reject; the payload is
turned into a column only if the schema asks for it. Length and digest of a payload are taken from the payload itself
where the record holds it, else from the revisit's headers.

NULL html is an empty payload, NULL urls have no target header, NULL ids an empty one. Rows that repeat the smallest id of
a payload are all responses. Line ends in a url are dropped. Extra columns are ignored, an empty table gives an archive
without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("page_id long, record_type string, url string, date string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
#: Compressed bytes that one read task takes, in whole files.
TASK_BYTES = 32 << 20


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four base32 digits."""
    digest, digits = F.sha1(data), []
    for at in range(8):
        n = F.conv(F.substring(digest, 5 * at + 1, 5), 16, 10).cast("int")
        digits += [F.substr(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*digits)


def records(pages: DataFrame, revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``value``: each page's record without its end. Of equal payloads the smallest id is stored once."""
    payload = F.coalesce("html", F.lit(""))
    slim = pages.select("page_id", "url", payload.alias("html"), F.octet_length(payload).cast("long").alias("n"))
    slim = slim.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    least = slim.groupBy("digest").agg(F.min("page_id").alias("least"))
    rows = slim.join(least, "digest")
    revisit = (F.col("n") >= revisit_from) & ~F.col("page_id").eqNullSafe(F.col("least"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.translate(F.col("url"), "\r\n", "")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("least")))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nX-Payload-Length: "), F.col("n").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.when(revisit, 0).otherwise(F.col("n")) + len(HTTP)).cast("string")))
    return rows.select(F.concat(head, F.lit(END + HTTP), F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    records(pages, **options).write.option("lineSep", END).option("compression", compression).text(path)


# --- reading ---


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class WarcReader(DataSourceReader):
    COLUMNS = ("page_id", "record_type", "url", "date", "refers_to", "payload_digest")

    def __init__(self, schema: StructType, options: dict):
        self.names, self.path = schema.fieldNames(), options["path"]
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))
        self.wanted: list[tuple[str, frozenset | None]] = []

    def pushFilters(self, filters: list[Filter]):
        """Equality, lists and not-null tests of header columns are decided here, all others by Spark."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in self.COLUMNS and isinstance(f, EqualTo):
                self.wanted.append((column, frozenset([f.value])))
            elif column in self.COLUMNS and isinstance(f, In):
                self.wanted.append((column, frozenset(f.value)))
            elif column in self.COLUMNS and isinstance(f, IsNotNull):
                self.wanted.append((column, None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, root = _file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
        tasks, room = [], 0
        for path, size in files:
            if not tasks or size > room:
                tasks.append([])
                room = self.task_bytes
            tasks[-1].append(path)
            room -= size
        return [Files(t) for t in tasks]

    def _unwanted(self, row: dict) -> bool:
        return any(row[c] is None or (values is not None and row[c] not in values) for c, values in self.wanted)

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = _file_system(self.path)
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, 1 << 20)
                yield from self._records(stream)

    def _records(self, stream) -> Iterator[tuple]:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                continue  # line ends between records
            head = {}
            while (line := stream.readline()).strip():
                key, _, value = line.decode("utf-8").partition(":")
                head[key.lower()] = value.strip()
            n = int(head["content-length"])
            row = {"page_id": _number(head.get("warc-record-id")), "record_type": head.get("warc-type"),
                   "url": head.get("warc-target-uri"), "date": head.get("warc-date"), "refers_to": _number(head.get("warc-refers-to")),
                   "payload_digest": (head.get("warc-payload-digest") or ":").split(":")[1] or None}
            if self._unwanted(row):
                _skip(stream, n)
                continue
            if row["record_type"] == "revisit" or not {"payload", "payload_bytes", "payload_digest"} & set(self.names):
                _skip(stream, n)
                length = head.get("x-payload-length")
                row |= {"payload": None, "payload_bytes": int(length) if length else None}
            else:
                payload = stream.read(n).partition(END.encode())[2]
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}
            yield tuple(row[c] for c in self.names)


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _skip(stream, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            break
        n -= got


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read_archives(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records of the archives below ``path``; name only the columns wanted in ``schema`` to spare the rest."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("warc").option("path", path)
    return (reader.schema(schema) if schema else reader).load()
