"""WARC archives as a PySpark Python data source, read and written.

Reading plans partitions of whole files. Conditions on headers are pushed down
and checked as soon as a record's headers are parsed; the content of records
that fail, or whose payload is not asked for, is passed over without being
looked at. Only the columns of the given schema are made.

Writing gives each task a file of its own in a folder beside the archive; they
move into place when the job commits, so lost and repeated tasks leave nothing.
Files are reached with pyarrow's file systems (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import gzip
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from ..session import store

VERSION = "WARC/1.1"
# Fixed value: the profile of a record whose payload equals that of an earlier one.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Columns, and the header each is read from; payload and its length come from the content.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string,"
    " refers_to string, payload_digest string, content_type string,"
    " payload_length bigint, payload binary"
)
KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

# Bytes of files put into one partition, and of payloads put into one batch.
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 8 << 20


def header_lines(stream: BinaryIO) -> dict[str, str] | None:
    """Headers of the next record, by lower-case name; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    headers: dict[str, str] = {}
    name = ""
    while (line := stream.readline()).strip():
        if line[:1] in b" \t" and name:  # a folded line
            headers[name] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()
    return headers


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head and body of a record's content."""
    head, mark, body = content.partition(b"\r\n\r\n")
    return (head, body) if mark else (content, b"")


def stated_length(head: bytes) -> int | None:
    found = re.search(rb"\r\ncontent-length:\s*(\d+)", head, re.I)
    return int(found[1]) if found else None


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class WarcReader(DataSourceReader):
    """Reads the files of a folder, or one file."""

    def __init__(self, path: str, columns: list[tuple[str, str]]):
        self.path, self.columns = path, columns
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes conditions on header columns; Spark checks the others."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((HEADERS[name], frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In):
                self.wanted.append((HEADERS[name], frozenset(f.value)))
            elif name in ("record_type", "record_id") and isinstance(f, IsNotNull):
                continue  # every record has them
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, put together up to a size, large ones alone."""
        system, root = fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.File:
            return [Files([root])]
        found = [
            x
            for x in system.get_file_info(fs.FileSelector(root))
            if x.type == fs.FileType.File and re.search(r"\.warc(\.gz)?$", x.base_name)
        ]
        parts, size = [], 0
        for x in sorted(found, key=lambda x: x.path):
            if not parts or size + x.size > PARTITION_BYTES:
                parts.append(Files([]))
                size = 0
            parts[-1].paths.append(x.path)
            size += x.size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        names = [n for n, _ in self.columns]
        content = bool({"payload", "payload_length"} & set(names))
        schema = pa.schema([(n, KINDS[k]) for n, k in self.columns])
        system, _ = fs.FileSystem.from_uri(self.path)
        rows: list[dict[str, Any]] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for path in partition.paths:
            with system.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
                while (headers := header_lines(stream)) is not None:
                    length = int(headers.get("content-length", 0))
                    keep = all(headers.get(h) in allowed for h, allowed in self.wanted)
                    if not (keep and content):
                        stream.seek(length, 1)
                        if not keep:
                            continue
                        row: dict[str, Any] = {}
                    else:
                        block = stream.read(length)
                        if len(block) < length:
                            raise ValueError(f"{path} ends inside a record")
                        if headers.get("content-type", "").startswith("application/http"):
                            head, body = http_parts(block)
                        else:
                            head, body = b"", block
                        full = headers.get("warc-type") != "revisit"
                        row = {
                            "payload": body if full else None,
                            "payload_length": len(body) if full else stated_length(head),
                        }
                        if "payload" in names:
                            size += len(body)
                    row |= {n: headers.get(HEADERS[n]) for n in names if n in HEADERS}
                    rows.append({n: row[n] for n in names})
                    if size > BATCH_BYTES or len(rows) >= 4096:
                        yield batch()
                        rows, size = [], 0
        yield batch()


def record(row: dict[str, Any]) -> bytes:
    """A record: WARC headers, HTTP head, and the payload unless it is a revisit."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    length = row.get("payload_length")
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload) if length is None else length}\r\n\r\n"
    ).encode()
    content = head if revisit else head + payload
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row.get("warc_date")),
        ("WARC-Target-URI", row.get("target_uri")),
        ("WARC-Payload-Digest", row.get("payload_digest")),
        ("WARC-Refers-To", row.get("refers_to")),
        ("WARC-Profile", IDENTICAL if revisit else None),
        ("Content-Type", row.get("content_type") or "application/http;msgtype=response"),
        ("Content-Length", str(len(content))),
    ]
    text = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in headers if v is not None)
    return f"{VERSION}\r\n{text}\r\n".encode() + content + b"\r\n\r\n"


def _one_line(value: str) -> str:
    """A header value without control characters, which are written in percent form."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceArrowWriter):
    """One file per task, a gzip member per record."""

    def __init__(self, path: str):
        self.path = path
        self.staging = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(f"{root}/{self.staging}", recursive=True)
        path = f"{root}/{self.staging}/part-{uuid.uuid4().hex}.warc.gz"
        with system.open_output_stream(path, compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(packer.compress(record(row)) + packer.flush())
        return Written([path])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for path in message.paths if message else ():
                system.move(path, f"{root}/{path.rpartition('/')[2]}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(
            self.options["path"], [(f.name, f.dataType.simpleString()) for f in schema.fields]
        )

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records of an archive; name only the columns that are needed in ``schema``."""
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


LEAST_SHARED = 100


def page_records(
    pages: DataFrame, least: int = LEAST_SHARED, page_id: str = "page_id", url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Records of all ``pages``: of equal payloads of ``least`` bytes or more one is kept whole.

    That is the one with the smallest id; the others are revisits of it. A NULL
    html is empty, a NULL url is no header, a NULL id is no id; rows equal in
    id and payload are alike, so if one is whole all are. No rows, no records.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("id"),
        F.col(f"`{url}`").alias("target_uri"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # Stored, as Spark can then split a payload with very many copies in the join.
    shared = store(
        rows.where(F.octet_length("payload") >= least)
        .groupBy(F.col("digest").alias("shared"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("shared", "first"),
        "shared-payloads",
    )
    joined = rows.join(shared, F.col("digest") == F.col("shared"), "left")
    revisit = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def urn(column: str):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn("id").alias("record_id"),
        "target_uri",
        F.lit("2025-01-01T00:00:00Z").alias("warc_date"),
        F.when(revisit, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_of(urn: str):
    """The page id in a record id."""
    return F.regexp_extract(urn, r"<urn:x-page:(-?\d+)>", 1).try_cast("long")


def write_pages(pages: DataFrame, path: str, **columns: str) -> None:
    """Write an archive of all ``pages`` to the folder ``path``."""
    register(pages.sparkSession)
    page_records(pages, **columns).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row per page of an archive: whole payloads are measured, revisits read from headers."""
    whole = (
        read_warc(spark, path, "record_type string, record_id string, payload binary")
        .where("record_type = 'response'")
        .select(
            page_of("record_id").alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
            "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
    )
    again = (
        read_warc(
            spark,
            path,
            "record_type string, record_id string, refers_to string, payload_digest string,"
            " payload_length bigint",
        )
        .where("record_type = 'revisit'")
        .select(
            page_of("record_id").alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
            "record_type",
            page_of("refers_to").alias("refers_to"),
        )
    )
    return whole.unionByName(again)
