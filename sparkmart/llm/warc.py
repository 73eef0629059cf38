"""WARC archives as a PySpark Python data source.

``spark.read.format("sparkmart_warc").load(path)`` plans file partitions from
the archive's manifest (runs of whole gzip members, so large files are split),
takes predicates on the record type and the other header columns, parses each
record's headers first and inflates a payload only when the record passes:
every member carries its compressed length in the gzip extra field ``sl``, so
the rest is skipped by a seek.  ``df.write.format("sparkmart_warc")`` writes
one archive file per task attempt; only files of successful tasks enter the
manifest, so a lost executor leaves no duplicate records.

Paths go through Arrow's file systems (local, HDFS, S3, ...), never ``open``.

Defined results: a null payload is empty; a record without a target URI has no
such header; pages with null page_id are responses, rows that repeat a page_id
refer to that page's response like any other page; an empty table gives an
archive without records.
"""

from __future__ import annotations

import base64
import io
import json
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from sparkmart.llm.common import broadcast_checked, shared_dir, stored

FORMAT = "sparkmart_warc"
SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, content_length long, payload_bytes long, payload binary"

#: Records with equal payloads of at least so many bytes are written once.
REVISIT_BYTES = 1000
#: Bytes of archive per read partition.
SPLIT_BYTES = 32 * 1024 * 1024
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
URN = "urn:page:"


def file_system(path: str):
    """Arrow file system of a Spark path and the path within it."""
    from pyarrow import fs

    path = str(path)
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers without the payload."""
    payload = bytes(row["payload"] or b"")
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_clean(row['record_id'])}>", f"WARC-Date: {DATE}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['payload_digest'])).decode()}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_clean(row['refers_to'])}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: gzip header with an extra field ``sl``: compressed length of the member, uncompressed length.
_MEMBER = struct.Struct("<4BI2BH2sHII")


def member(record: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    size = _MEMBER.size + len(body) + 8
    return _MEMBER.pack(31, 139, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(record)) + body + struct.pack("<II", zlib.crc32(record), len(record))


def parse_headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return out


@dataclass
class Span(InputPartition):
    path: str
    start: int
    stop: int


@dataclass
class Written(WriterCommitMessage):
    name: str
    size: int
    cuts: list  # member starts, about SPLIT_BYTES apart
    records: int


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` ("true" unless "false": leave payloads undecoded)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


#: Header predicates that the reader evaluates itself, by filter class.
_TESTS = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
}
_HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "content_length")


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.filters = []

    def pushFilters(self, filters):
        """Keep what the headers decide; hand the rest back to Spark."""
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _HEADER_COLUMNS:
                self.filters.append((f.attribute[0], type(f).__name__, f.value))
            else:
                yield f

    def partitions(self):
        fs, path = file_system(self.path)
        with fs.open_input_stream(f"{path}/manifest.json") as f:
            files = json.loads(f.read())
        return [
            Span(f"{self.path}/{x['name']}", a, b)
            for x in files
            for a, b in zip(x["cuts"], [*x["cuts"][1:], x["size"]], strict=True)
            if a < b
        ] or [Span("", 0, 0)]

    def _passes(self, values: dict) -> bool:
        tests = {k.__name__: v for k, v in _TESTS.items()}
        return all(values[c] is not None and tests[kind](values[c], x) for c, kind, x in self.filters)

    def read(self, partition):
        if partition.start >= partition.stop:
            return
        fs, path = file_system(partition.path)
        with fs.open_input_file(path) as f:
            f.seek(partition.start)
            source = io.BufferedReader(_Raw(f, partition.stop), 1 << 20)
            while head := source.read(_MEMBER.size):
                size = _MEMBER.unpack(head)[10]
                body = source.read(size - _MEMBER.size - 8)
                source.read(8)
                z = zlib.decompressobj(-15)
                first = z.decompress(body, 2048)  # headers first
                while b"\r\n\r\n" not in first and z.unconsumed_tail:
                    first += z.decompress(z.unconsumed_tail, 2048)
                warc, _, rest = first.partition(b"\r\n\r\n")
                h = parse_headers(warc)
                digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                values = {
                    "record_id": h.get("warc-record-id", "").strip("<>") or None,
                    "record_type": h.get("warc-type"),
                    "target_uri": h.get("warc-target-uri"),
                    "refers_to": h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                    "payload_digest": base64.b32decode(digest).hex() if digest else None,
                    "content_length": int(h["content-length"]),
                }
                if not self._passes(values):
                    continue  # the payload stays compressed
                while b"\r\n\r\n" not in rest and z.unconsumed_tail:
                    rest += z.decompress(z.unconsumed_tail, 2048)
                http, _, payload = rest.partition(b"\r\n\r\n")
                stated = int(parse_headers(http).get("content-length", 0))
                if values["record_type"] == "revisit" or not self.payload:
                    body_bytes = None
                else:
                    payload += z.decompress(z.unconsumed_tail) + z.flush()
                    body_bytes = payload[: values["content_length"] - len(http) - 4]
                yield (*values.values(), stated, body_bytes)


class _Raw(io.RawIOBase):
    """The bytes of an Arrow file up to ``stop``."""

    def __init__(self, f, stop):
        self.f, self.stop = f, stop

    def readable(self):
        return True

    def readinto(self, b):
        data = self.f.read(min(len(b), self.stop - self.f.tell()))
        b[: len(data)] = data
        return len(data)


class WarcWriter(DataSourceWriter):
    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        name, size, records, cuts = f"{uuid.uuid4().hex}.warc.gz", 0, 0, [0]
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            for row in iterator:
                if size - cuts[-1] >= SPLIT_BYTES:
                    cuts.append(size)
                data = member(record_bytes(row.asDict()))
                out.write(data)
                size += len(data)
                records += 1
        return Written(name, size, cuts, records)

    def commit(self, messages):
        """The manifest names the files of the tasks that succeeded, a line per task."""
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        files = [{"name": m.name, "size": m.size, "cuts": m.cuts, "records": m.records} for m in messages if m and m.records]
        with fs.open_output_stream(f"{path}/manifest.json") as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages):
        fs, path = file_system(self.path)
        for m in messages:
            if m:
                fs.delete_file(f"{path}/{m.name}")


def page_records(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One record row per page: the largest page_id of equal payloads is the response, the others revisit it."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.length("payload").cast("long"))
    large = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
    groups = large.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = stored(groups, "warc-groups").withColumnRenamed("payload_digest", "__digest")
    rows = rows.join(broadcast_checked(groups, 64), F.col("payload_digest") == F.col("__digest"), "left")
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("page_id"))
    return rows.select(
        F.concat(F.lit(URN), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, F.concat(F.lit(URN), F.col("first").cast("string"))).alias("refers_to"),
        "payload_digest",
        F.lit(None).cast("long").alias("content_length"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(records: DataFrame, path: str) -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.select(*T.StructType.fromDDL(SCHEMA).fieldNames()).write.format(FORMAT).mode("append").save(path)


def read_archive(spark, path: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the pages' archive, read it back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response come from the payload as read; those of a
    revisit from its headers, which hold those of the full payload.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archive(page_records(pages, min_bytes), path)
    back = read_archive(spark, path)

    def page(c):
        return F.regexp_replace(c, f"^{URN}", "").try_cast("long")

    own = F.col("payload").isNotNull()
    return back.select(
        page("record_id").alias("page_id"),
        F.when(own, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
