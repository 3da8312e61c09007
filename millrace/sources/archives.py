"""Zip archives: their members as files below the raw layer, or as rows of text lines."""

from __future__ import annotations

import io
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from millrace.session import qualified, scratch_path

# Lines per emitted frame: a member of any size streams through a worker.
LINES_PER_FRAME = 20_000
# Folder prefix of the members and its name in the layered store.
MEMBER_PREFIX, TARGET_PREFIX = "Process/", "process_time_series/"


# Any case of the ending.
ARCHIVES = "*.[zZ][iI][pP]"
COPY_BYTES = 8 << 20
# What a broken archive or member raises; anything else, such as a store that does not
# answer, fails the task and is tried again.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, pa.ArrowInvalid)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI, as Python on an executor reaches it."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme):]
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.removeprefix("file://").removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def target_name(member: str) -> str:
    return TARGET_PREFIX + member[len(MEMBER_PREFIX):] if member.startswith(MEMBER_PREFIX) else member


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, bytes, error) of all zip files below ``path``.

    Only the directory of an archive is read, whatever its size. One that cannot be opened
    gives a row without a member.
    """
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", ARCHIVES).load(path).select("path"))

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for archive in frame["path"]:
                system, place = open_store(archive)
                try:
                    with system.open_input_file(place) as stream, zipfile.ZipFile(stream) as opened:
                        rows += [(archive, m.filename, m.file_size, None) for m in opened.infolist() if not m.is_dir()]
                except BROKEN as error:
                    rows.append((archive, None, None, str(error)))
            yield pd.DataFrame(rows, columns=["archive", "member", "bytes", "error"])

    return found.mapInPandas(members, "archive string, member string, bytes bigint, error string")


def archives_to_bronze(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write every member below ``target``, under its name in the layered store.

    A task copies one member at a time, in pieces, under a temporary name that it changes at
    the end, so a large archive is shared by many tasks and a repeated task does no harm.
    Returns (archive, member, bytes, error): broken archives and members have an error and no
    file; the others are all there.
    """
    target = qualified(spark, target)
    members = list_members(spark, path)
    listed = scratch_path(spark, "members")
    members.write.parquet(listed)
    members = spark.read.schema(members.schema).parquet(listed)

    def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors = list(frame["error"])
            for i, (archive, member) in enumerate(zip(frame["archive"], frame["member"])):
                if member is None:
                    continue
                source, place = open_store(archive)
                sink, root = open_store(target)
                final = f"{root}/{target_name(member)}"
                attempt = f"{root}/_temporary/{uuid.uuid4().hex}"
                sink.create_dir(attempt.rpartition("/")[0], recursive=True)
                try:
                    with source.open_input_file(place) as stream, zipfile.ZipFile(stream) as opened, \
                            opened.open(member) as own, sink.open_output_stream(attempt, compression=None) as out:
                        while block := own.read(COPY_BYTES):
                            out.write(block)
                except BROKEN as error:
                    errors[i] = str(error)
                    sink.delete_file(attempt)
                    continue
                sink.create_dir(final.rpartition("/")[0], recursive=True)
                sink.move(attempt, final)
            yield frame.assign(error=errors)

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartition(width, "archive", "member")
    report = scratch_path(spark, "expanded")
    dealt.mapInPandas(copy, members.schema).write.parquet(report)
    return spark.read.schema(members.schema).parquet(report)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the zip files below ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", ARCHIVES).load(path).select("path", "content"))


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for archive, content in zip(frame["path"], frame["content"]):
            try:
                opened = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile:
                yield _lines(archive, None, [None], 0)
                continue
            for member in opened.namelist():
                if member.endswith("/"):
                    continue
                target, batch, first = target_name(member), [], 0
                try:
                    with io.TextIOWrapper(opened.open(member), "utf-8-sig") as stream:
                        for line in stream:
                            batch.append(line.rstrip("\r\n"))
                            if len(batch) == LINES_PER_FRAME:
                                yield _lines(archive, target, batch, first)
                                first, batch = first + len(batch), []
                except (*BROKEN, UnicodeDecodeError):
                    # The member's number of lines is unknown from here on.
                    batch.append(None)
                if batch:
                    yield _lines(archive, target, batch, first)


def _lines(archive: str, member: str | None, lines: list, first: int) -> pd.DataFrame:
    return pd.DataFrame({"archive": archive, "member": member,
                         "line_no": range(first, first + len(lines)), "line": lines},
                        columns=["archive", "member", "line_no", "line"])


def expand_archives(archives: DataFrame) -> DataFrame:
    """(archive, member, line_no, line) of all members; folder entries are skipped.

    The data folder prefix of a member is renamed to the layered store's name. An
    archive that cannot be opened gives one row without member and line, a member that cannot
    be read to its end a last row without line.
    """
    return archives.select("path", "content").mapInPandas(
        _expand, "archive string, member string, line_no bigint, line string")
