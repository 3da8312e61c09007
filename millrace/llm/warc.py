"""Deterministic sharded WARC writer, and a reader.

Records are range-sorted by page id into shards; a shard's records go one after the other into
files that are closed once their compressed size reaches ``roll_bytes``. Shard bounds come from
a sample that a digest of the id chooses, record ids, dates and gzip headers are fixed by the
content, so equal tables give equal files, byte for byte, however Spark deals out the rows.

Each task writes its files under temporary names and reports them. The report is committed by
Spark's own table commit, so it names one attempt of each task; then the named files get their
final names, and last the manifest is written. A reader takes what the manifest lists.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import written
from millrace.session import qualified, scratch_path
from millrace.sources.archives import open_store

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAMPLE = 64
LOWEST = -2**63
#: Compressed bytes that the reader unpacks at a time.
CHUNK = 16 << 10


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{key}')}>"


def _record(kind: str, page_id, url, payload: bytes, key: str, refers, date: str) -> bytes:
    """One gzip member. A revisit keeps the HTTP head, whose length is that of the payload."""
    digest = base32_sha1(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + b"\r\n\r\n" + (payload if kind == "response" else b""))
    head = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, key)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers, key)), ("X-Refers-To-Page", str(refers))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return _member(text.encode() + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    """A gzip member without time or name, so that it depends on ``data`` alone."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class _Roller:
    """Writes the members of a shard to files of about ``roll_bytes``."""

    def __init__(self, system: fs.FileSystem, folder: str, roll_bytes: int):
        self.system, self.folder, self.roll_bytes = system, folder, roll_bytes
        self.attempt, self.stream = uuid.uuid4().hex, None
        self.files: list[dict] = []
        system.create_dir(f"{folder}/_temporary", recursive=True)

    def add(self, shard: int, member: bytes) -> None:
        if self.stream is not None and (shard != self.shard or self.size >= self.roll_bytes):
            self.close()
        if self.stream is None:
            self.part = self.part + 1 if self.files and shard == self.shard else 0
            self.shard, self.size, self.records, self.digest = shard, 0, 0, hashlib.sha256()
            self.name = f"{shard:06d}-{self.part:05d}.warc.gz"
            self.stream = self.system.open_output_stream(f"{self.folder}/_temporary/{self.attempt}-{self.name}", compression=None)
        self.stream.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.files.append({"file": self.name, "temporary": f"{self.attempt}-{self.name}", "records": self.records,
                               "bytes": self.size, "sha256": self.digest.hexdigest()})
            self.stream = None


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = 128 << 20, roll_bytes: int = 16 << 20,
                   least: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the manifest.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page
    id is the response, and the others revisit it. A null html is an empty payload; a null url
    leaves out the target. Null ids come first and revisit any equal payload that has an id;
    among themselves they are responses, as are rows that repeat the id and payload of one.
    Other columns are ignored; an empty table gives an empty manifest. Payloads are whole.

    Two payloads are equal if their SHA-256 is.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    size = F.octet_length("payload")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-facts["bytes"] // shard_bytes))
    bounds = _bounds(rows, shards, facts["n"])
    # Narrow rows find the responses; the payloads move once, to their shard.
    keys = rows.where(size >= least).select("page_id", "key")
    groups = (keys.groupBy("key").agg(F.max("page_id").alias("refers"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("refers").isNotNull()).drop("n"))
    marks = (keys.join(groups, "key").where(~F.col("page_id").eqNullSafe(F.col("refers"))).distinct()
             .select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
                     "key", "refers", F.lit(0).alias("kind")))
    records = marks.unionByName(rows.withColumn("refers", F.lit(None).cast("bigint")).withColumn("kind", F.lit(1)))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    sorted_rows = (records.withColumn("shard", shard_of(F.coalesce("page_id", F.lit(LOWEST))))
                   .repartition(int(shards), "shard")
                   .sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "key", "kind", "url")
                   .select("shard", "page_id", "key", "kind", "refers", "url", "payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = open_store(folder)
        out, mark = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for shard, page_id, key, kind, refers, url, body in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if kind == 0:
                        mark = (page_id, key, refers)
                        continue
                    original = mark[2] if mark is not None and mark[:2] == (page_id, key) else None
                    out = out or _Roller(system, place, roll_bytes)
                    out.add(shard, _record("response" if original is None else "revisit", page_id, url, body, key,
                                           original, date))
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist(out.files, schema=files)

    files = pa.schema([("file", pa.string()), ("temporary", pa.string()), ("records", pa.int64()),
                       ("bytes", pa.int64()), ("sha256", pa.string())])
    report = written(sorted_rows.mapInArrow(write, "file string, temporary string, records bigint, bytes bigint, sha256 string"),
                     "warc-report")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = open_store(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = f"{place}/_temporary/{temporary}"
                # A repeated task finds its work done.
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, f"{place}/{name}")
            yield batch

    done = report.mapInArrow(rename, report.schema).drop("temporary")
    done.write.json(f"{folder}/manifest")
    return spark.read.schema(done.schema).json(f"{folder}/manifest")


def _bounds(rows: DataFrame, shards: int, n: int) -> np.ndarray:
    """First ids of all shards but the first. About ``SAMPLE`` ids a shard reach the driver."""
    if shards == 1:
        return np.empty(0, np.int64)
    every = max(1, n // (SAMPLE * shards))
    sample = rows.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
    ids = np.sort(np.array([r[0] for r in sample.select("page_id").collect()], np.int64))
    return np.unique(ids[[len(ids) * i // shards for i in range(1, shards)]]) if len(ids) else ids


def _members(data: bytes) -> Iterator[bytes]:
    """Gzip members, one by one. What follows a member is copied up to a chunk only."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            chunk = view[at:at + CHUNK]
            if not chunk:
                raise ValueError("a gzip member is cut off")
            parts.append(unpack.decompress(chunk))
            at += len(chunk) - len(unpack.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {p[0].lower(): p[1] if len(p) > 1 else "" for p in pairs}


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Payload digests of responses are computed anew and must agree with the record's. A file that
    the manifest lists and that is missing, or has other bytes or records, raises an error.
    """
    # The manifest has a row a file; files that it does not list were never committed.
    listed = spark.read.schema("file string, records bigint, sha256 string").json(f"{folder}/manifest").distinct()
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
             .withColumn("file", F.element_at(F.split("path", "/"), -1)))
    missing = listed.join(found.select("file"), "file", "left_anti").first()
    if missing is not None:
        raise FileNotFoundError(f"{folder} lacks {missing['file']}, which its manifest lists")
    files = found.select("content", "file").join(listed, "file").select("content", "file", "records", "sha256")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, file, records, sha256 in zip(*(batch.column(i) for i in range(4))):
                rows, data = [], content.as_py()
                if hashlib.sha256(data).hexdigest() != sha256.as_py():
                    raise ValueError(f"{file} has other bytes than its manifest says")
                for record in _members(data):
                    head, _, rest = record.partition(b"\r\n\r\n")
                    fields = _fields(head)
                    http, _, body = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response" and base32_sha1(body) != digest:
                        raise ValueError(f"payload digest of {fields['warc-record-id']} is wrong")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
                    rows.append({"page_id": int(page) if page else None, "url": fields.get("warc-target-uri"),
                                 "payload_bytes": int(_fields(http)["content-length"]), "payload_digest": digest,
                                 "record_type": fields["warc-type"], "refers_to": int(refers) if refers else None})
                if len(rows) != records.as_py():
                    raise ValueError(f"{file} has {len(rows)} records, its manifest says {records}")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    return files.mapInArrow(parse, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                   "record_type string, refers_to bigint")


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared place."""
    return scratch_path(spark, "warc")
