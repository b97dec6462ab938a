"""WARC 1.1 archives as a Spark data source in Python.

Writing: each task writes one archive under a name of its own attempt; the commit
lists the finished archives in a manifest, so files of failed attempts are never
read. A folder without a manifest (archives from elsewhere, plain or with gzip
members) is read whole. Reading: archives are planned into partitions of similar
size; pushed filters on the record type and other header columns are tested on the
headers, and the block of a record that fails them is skipped by its length,
undecoded. The option ``payload=false`` skips every block; ``payload=checked`` reads
blocks only to compare their digest, and gives no payload.

A response's record id is made of its page id, payload digest and length, so that a
revisit names the record it refers to without a second pass.

Paths may be on any store that pyarrow's file systems open (``file``, ``hdfs``,
``s3``, ...), and must be one that driver and executors share.

Defined results: a null payload is written as empty; a null url or page id leaves
its header out and reads back as null; characters a header cannot hold are
percent-encoded in the url; repeated rows become records of their own; an empty
table gives a manifest without archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from payrun.llm.common import stage

FORMAT = "llm_warc"
SCHEMA = ("record_id string, record_type string, target_uri string, page_id long, payload_digest string, "
          "payload_bytes long, refers_to long, payload binary")
HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "page_id", "payload_digest", "payload_bytes", "refers_to")
BROADCAST_ROWS = 200_000            # of about 100 bytes
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS = uuid.UUID("8c1f9ad2-52a5-4f43-9a53-6a2f2d9a1d11")       # name space of record ids


def record_id(page_id: int, digest: str, length: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORDS, f'{page_id}:{digest}:{length}')}>"


def open_fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else "file:" + path.removeprefix("file:"))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(row: dict) -> bytes:
    """One WARC record; a revisit keeps the payload's length and digest only."""
    payload = row["payload"] or b""
    digest = base32_sha1(payload)
    named = row["record_type"] == "response" and row["page_id"] is not None
    own = record_id(row["page_id"], digest, len(payload)) if named else f"<urn:uuid:{uuid.uuid4()}>"
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", own), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if row["target_uri"] is not None:
        head.append(("WARC-Target-URI", quote(row["target_uri"], safe="%/:=&?~#+!$,;'@()*[]-._")))
    head += [("WARC-Payload-Digest", "sha1:" + digest), ("X-Payload-Length", str(len(payload)))]
    if row["page_id"] is not None:
        head.append(("X-Page-ID", str(row["page_id"])))
    if row["record_type"] == "revisit":
        head += [("WARC-Refers-To", record_id(row["refers_to"], digest, len(payload))), ("X-Refers-To-Page-ID", str(row["refers_to"])),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        payload = b""
    block = HTTP_HEAD + payload
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Archives(InputPartition):
    files: list[str]

    def __init__(self, files: list[str]):
        self.files = files


@dataclass
class Written(WriterCommitMessage):
    name: str
    size: int


class WarcSource(DataSource):
    """``format("llm_warc")``; options ``path``, ``payload`` and ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> "WarcReader":
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> "WarcWriter":
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder instead")
        return WarcWriter(self.options["path"])


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        name, size = f"part-{uuid.uuid4().hex}.warc", 0
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                out = out or fs.open_output_stream(f"{root}/{name}")
                size += out.write(data := record_bytes(row)) or len(data)
        if out:
            out.close()
        return Written(name if out else "", size)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        listed = [{"name": m.name, "size": m.size} for m in messages if m and m.name]
        with fs.open_output_stream(f"{root}/manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Archives that no manifest lists are never read."""


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = str(options.get("payload", "true")).lower()
        if self.payload not in ("true", "false", "checked"):
            raise ValueError("payload is true, false or checked")
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take the filters that headers decide; hand the others back."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if column not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "known", None))
            else:
                yield f

    def partitions(self) -> list[Archives]:
        fs, root = open_fs(self.path)
        listed, found, manifests = [], [], 0
        for info in fs.get_file_info(pyarrow.fs.FileSelector(root)):
            if info.base_name.startswith("manifest-"):
                manifests += 1
                with fs.open_input_stream(info.path) as f:
                    listed += [(x["size"], x["name"]) for x in json.loads(f.read())]
            elif info.base_name.endswith((".warc", ".warc.gz")):
                found.append((info.size, info.base_name))
        listed = listed if manifests else found
        plan: list[Archives] = []
        room = 0
        for size, name in sorted(listed, reverse=True):
            if not plan or size > room:
                plan.append(Archives([]))
                room = self.partition_bytes
            plan[-1].files.append(f"{self.path}/{name}")
            room -= size
        return plan or [Archives([])]

    def wanted(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            have = row[column]
            if have is None or kind == "in" and have not in value or kind == "prefix" and not have.startswith(value):
                return False
        return True

    def read(self, partition: Archives) -> Iterator[tuple]:
        for path in partition.files:
            fs, place = open_fs(path)
            with io.BufferedReader(fs.open_input_file(place), 1 << 20) as f:
                yield from self.records(gzip.GzipFile(fileobj=f) if path.endswith(".gz") else f)

    def records(self, f: io.BufferedReader | gzip.GzipFile) -> Iterator[tuple]:
        """Headers first; then the block is read, or skipped by its length."""
        while first := f.readline():
            if not first.strip():
                continue
            if not first.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {first[:40]!r}")
            head = {}
            while (line := f.readline().rstrip(b"\r\n")):
                key, _, value = text_of(line).partition(":")
                head[key.strip().lower()] = value.strip()
            length = int(head["content-length"])
            row = {
                "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"),
                "target_uri": head.get("warc-target-uri"),
                "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
                "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                "payload_bytes": int(head["x-payload-length"]) if "x-payload-length" in head else None,
                "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
            }
            if not self.wanted(row) or self.payload == "false" or row["record_type"] != "response":
                f.seek(length + 4, io.SEEK_CUR)
                if self.wanted(row):
                    yield (*row.values(), None)
                continue
            block = f.read(length)
            f.seek(4, io.SEEK_CUR)
            payload = block.partition(b"\r\n\r\n")[2]
            if row["payload_digest"] not in (None, base32_sha1(payload)) and "sha1:" in head["warc-payload-digest"]:
                raise ValueError(f"damaged record {row['record_id']}")
            row["payload_bytes"] = len(payload)
            yield (*row.values(), payload if self.payload == "true" else None)


def text_of(line: bytes) -> str:
    """A header line; one that is not UTF-8 is read byte for byte."""
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def mark_revisits(pages: DataFrame, min_bytes: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Records to write: of equal payloads of at least ``min_bytes`` bytes the
    smallest page id is the response and the others revisit it.

    Only digests are shuffled: the first id of each payload that occurs more than once
    is a partial aggregate (a payload that a third of all pages share costs one row a
    task). These few rows go to every task, where up to ``broadcast_rows`` of them are
    counted, and pages are written from their scan; more are joined by Spark, which
    splits a hot payload.
    """
    body = F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("target_uri"),
                        body.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
    first = stage(rows.groupBy("digest", "n").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
                  .where(F.col("copies") > 1).drop("copies"), "repeated")
    if first.count() <= broadcast_rows:
        first = F.broadcast(first)
    whole = F.col("page_id").eqNullSafe(F.col("first_id")) | F.col("first_id").isNull() | (F.col("n") < min_bytes)
    return (rows.join(first, ["digest", "n"], "left")
            .select(F.lit(None).cast("string").alias("record_id"),
                    F.when(whole, "response").otherwise("revisit").alias("record_type"), "target_uri", "page_id",
                    F.lit(None).cast("string").alias("payload_digest"), F.col("n").cast("long").alias("payload_bytes"),
                    F.when(~whole, F.col("first_id")).alias("refers_to"), "payload"))


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format(FORMAT).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool | str = True) -> DataFrame:
    """Records of a folder; ``payload`` is true, false or "checked"."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).option("payload", str(payload).lower()).load()
