"""WARC archives as a PySpark Python data source.

``spark.read.format("warc").load(path)`` plans the archive files into
partitions by size, takes predicates on the record type and other header fields
into the scan, parses a record's headers first and steps over the block of a
record that no predicate wants; with ``option("payload", "false")`` it steps over every
block. ``df.write.format("warc").save(path)`` writes records in tasks; only
files named by a committed task enter the manifest the reader goes by, so lost or
repeated attempts leave nothing that is read.

Files roll at ``maxFileBytes``; a ``.warc.gz`` file (``compression`` gzip) holds one
gzip member per record. Paths may be of any file system pyarrow reaches (local, hdfs,
s3, gs). A record's payload is held whole, nothing larger.

Defined results: a null payload is written as empty; line ends and control
characters in a header value become spaces; a header that is missing reads as
null; an archive without records or a folder without files reads as no rows; files
put there by others are read if there is no manifest at all.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In,
                                    InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)

#: Record columns and the header fields they stand for (fixed values of the format).
HEADER_OF = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADER_OF) + ", payload_length bigint, extra map<string,string>, payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"
BATCH_BYTES = 8 << 20
_CONTROL = re.compile(r"[\x00-\x1f\x7f]+")
_KNOWN = {h.lower(): c for c, h in HEADER_OF.items()}


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def record_bytes(row: dict) -> bytes:
    """One record: headers, the HTTP head and, unless it is a revisit, the payload."""
    payload = row.get("payload") or b""
    revisit = row.get("record_type") == "revisit"
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1"]
    head += [f"{h}: {_CONTROL.sub(' ', str(row[c]))}" for c, h in HEADER_OF.items() if row.get(c) is not None]
    head += [f"{k}: {_CONTROL.sub(' ', str(v))}" for k, v in (row.get("extra") or ()) if v is not None]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Committed(WriterCommitMessage):
    files: list[tuple[str, int]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.gzip = options.get("compression", "none") == "gzip"
        self.max_bytes = int(options.get("maxFileBytes", 256 << 20))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _file_system(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                data = record_bytes(row)
                if self.gzip:
                    data = gzip.compress(data, 6, mtime=0)
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                out.write(data)
                size += len(data)
                if size >= self.max_bytes:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Committed(files)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        system, root = _file_system(self.path)
        system.create_dir(f"{root}/{MANIFEST}", recursive=True)
        if self.overwrite:
            for info in system.get_file_info(pafs.FileSelector(f"{root}/{MANIFEST}")):
                system.delete_file(info.path)
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{root}/{MANIFEST}/{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        system, root = _file_system(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                system.delete_file(f"{root}/{name}")


@dataclass
class _Files(InputPartition):
    files: list[str]

    def __init__(self, files):
        super().__init__(files)
        self.files = files


class _Input:
    """The records of one archive file, headers first; ``skip`` steps over a block."""

    def __init__(self, raw, zipped: bool):
        self.zipped = zipped
        self.raw = raw
        self.stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if zipped else raw, 1 << 18)
        self.left = 0

    def headers(self) -> dict[str, str] | None:
        self.skip(self.left)
        self.left = 0
        line = self.stream.readline()
        while line in (b"\r\n", b"\n"):
            line = self.stream.readline()
        if not line:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {line[:60]!r}")
        found: dict[str, str] = {}
        for line in iter(self.stream.readline, b""):
            line = line.rstrip(b"\r\n")
            if not line:
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            found[name.strip()] = value.strip()
        lower = {k.lower(): v for k, v in found.items()}
        self.left = int(lower.get("content-length", 0))
        return found

    def skip(self, n: int) -> None:
        if n and not self.zipped:
            self.stream.seek(n, 1)
        while n and self.zipped:
            got = len(self.stream.read(min(n, 1 << 20)))
            if not got:
                break
            n -= got

    def block(self, n: int | None = None) -> bytes:
        data = self.stream.read(self.left if n is None else min(n, self.left))
        self.left -= len(data)
        return data

    def http_head(self) -> bytes:
        """The block up to the payload."""
        head = b""
        while self.left:
            line = self.stream.readline(self.left)
            self.left -= len(line)
            head += line
            if line in (b"\r\n", b"\n", b""):
                break
        return head


class _Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("maxPartitionBytes", 64 << 20))
        self.names = [f.name for f in schema.fields]
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes predicates on header columns; the others go back to Spark."""
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if column in HEADER_OF and isinstance(f, EqualTo):
                self.wanted.append((column, "in", (f.value,)))
            elif column in HEADER_OF and isinstance(f, EqualNullSafe) and f.value is not None:
                self.wanted.append((column, "in", (f.value,)))
            elif column in HEADER_OF and isinstance(f, In):
                self.wanted.append((column, "in", tuple(f.value)))
            elif column in HEADER_OF and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", f.value))
            elif column in HEADER_OF and isinstance(f, IsNotNull):
                self.wanted.append((column, "there", None))
            else:
                yield f

    def partitions(self):
        system, root = _file_system(self.path)
        if system.get_file_info(root).type == pafs.FileType.File:
            return [_Files([self.path])]
        manifests = [i for i in system.get_file_info(pafs.FileSelector(f"{root}/{MANIFEST}", allow_not_found=True)) if i.is_file]
        if manifests:
            files = []
            for info in manifests:
                with system.open_input_stream(info.path, compression=None) as f:
                    files += [(f"{self.path}/{name}", size) for name, size in json.loads(f.read())]
        else:
            files = [(f"{self.path}/{i.path[len(root):].lstrip('/')}", i.size)
                     for i in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
                     if i.is_file and i.path.endswith((".warc", ".warc.gz"))]
        plans, names, size = [], [], 0
        for name, n in sorted(files):
            if names and size + n > self.partition_bytes:
                plans.append(_Files(names))
                names, size = [], 0
            names.append(name)
            size += n
        return [*plans, _Files(names)]

    def _wants(self, row: dict) -> bool:
        for column, how, value in self.wanted:
            got = row[column]
            if got is None or how == "in" and got not in value or how == "starts" and not got.startswith(value):
                return False
        return True

    def _rows(self, name: str) -> Iterator[dict]:
        system, path = _file_system(name)
        with system.open_input_file(path) as raw:
            records = _Input(raw, name.endswith(".gz"))
            while (headers := records.headers()) is not None:
                row = dict.fromkeys(HEADER_OF)
                extra = []
                for k, v in headers.items():
                    column = _KNOWN.get(k.lower())
                    if column:
                        row[column] = v
                    elif k.lower() not in ("content-type", "content-length"):
                        extra.append((k, v))
                if not self._wants(row):
                    continue  # the block is stepped over
                http = headers.get("Content-Type", "").startswith("application/http")
                head = records.http_head() if http else b""
                stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
                row["payload_length"] = int(stated[1]) if stated else records.left
                row["extra"] = extra
                # a revisit carries no payload, which is not the same as an empty one
                row["payload"] = records.block() if self.payload and row["record_type"] != "revisit" else None
                yield row

    def read(self, partition):
        schema = pa.schema([(c, pa.string()) for c in HEADER_OF] + [
            ("payload_length", pa.int64()), ("extra", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        rows, size = [], 0
        for name in partition.files:
            for row in self._rows(name):
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema).select(self.names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema).select(self.names)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, schema)

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def with_revisits(pages, key: str, payload: str, at_least: int = 1000):
    """``pages`` with payload_length, payload_digest (hex SHA-1), record_type and
    refers_to: of equal payloads of ``at_least`` bytes the one with the largest key
    is the response, the others revisit it. Rows that share the largest key, and
    rows of groups without any key, are all responses."""
    from pyspark.sql import functions as F

    from itemscope.llm.common import join_measured, saved

    known = pages.withColumn("payload_length", F.octet_length(payload).cast("bigint")).withColumn("payload_digest", F.sha1(payload))
    large = known.filter(F.col("payload_length") >= at_least).groupBy("payload_length", "payload_digest")
    groups = saved(large.agg(F.max(key).alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "payload-groups")
    joined = join_measured(known, groups, ["payload_length", "payload_digest"], "left", F.lit(96))
    revisit = F.col("_last").isNotNull() & ~F.col(key).eqNullSafe(F.col("_last"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")) \
        .withColumn("refers_to", F.when(revisit, F.col("_last"))).drop("_last")
