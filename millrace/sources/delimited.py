"""Delimited text files whose headers differ from file to file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.cleaning import find_column, normalize_columns
from millrace.operators.features import union_by_name

# Roles of columns, and the name parts by which a file's header is searched, in order.
PROCESS_ROLES = {"time": ("time", "date"), "speed": ("speed",), "code": ("code", "product")}
# So large that no two files share a partition; small enough to be added up.
ONE_FILE = str(1 << 42)
# Bits of a row's number in its partition, in monotonically_increasing_id.
ROW_BITS = (1 << 33) - 1
MALFORMED = "__malformed"


def role(name: str) -> str:
    """Column that holds the file's own column for a role, as text."""
    return f"__role_{name}"


@contextmanager
def _no_shared_partitions(spark: SparkSession):
    """A partition has one file, or one block of a large file."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, ONE_FILE)
        yield
    finally:
        spark.conf.set(key, before)


def header_groups(spark: SparkSession, path: str, glob: str = "*.csv") -> list[tuple[str, str | None]]:
    """(path, header line) of every file that is not empty; None for an empty first line.

    Spark reads the files, by whatever scheme it knows, on the executors, block by block; the first
    line of a file is the first row of its first block, and no other leaves the scan. A file that cannot be read fails the job: it is not taken for one
    without a header. Spark keeps the list of all files on the driver anyway; this adds a line
    to each.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": glob}
    listed = (spark.read.format("binaryFile").options(**options).load(path)
              .select("path", F.col("_metadata.file_path").alias("uri")))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    lines = spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("line_uri"), F.col("_metadata.file_block_start").alias("__block"),
        number.alias("__row"), F.col("value").alias("header"))
    with _no_shared_partitions(spark):
        first = lines.where("__block = 0 AND __row = 0").select("line_uri", "header")
        found = listed.join(first, F.col("uri") == F.col("line_uri"), "left").select("path", "header").collect()
    return [(r["path"], (r["header"] or "").lstrip("﻿") or None) for r in found]


def read_process_csv(spark: SparkSession, path: str, sep: str = ";", glob: str = "*.csv",
                     roles: Mapping[str, Sequence[str]] = PROCESS_ROLES,
                     needed: Sequence[str] = ("time", "speed"),
                     moved: Sequence[str] = ("time",)) -> tuple[DataFrame | None, DataFrame]:
    """(rows, quarantine). Columns are matched by name, as text.

    One read over files with different column orders would put values in wrong columns, so
    files are grouped by their header line and each group is read with its own schema. Which
    column plays a role is decided for each group (the first whose name has one of the role's
    parts); its values are repeated in ``__role_<role>``, so groups with differing names agree. Of
    the ``moved`` roles only that column is left.
    Rows carry ``source_path``, which names a file, and ``source_file`` for display.

    ``quarantine`` (path, reason, line) has the files without a readable header or without a
    ``needed`` role, which are not read, and the rows that do not fit their header.
    """
    groups, rejected = {}, []
    for file, header in header_groups(spark, path, glob):
        names = [c.strip().strip('"') for c in header.split(sep)] if header else []
        folded = [c.lower() for c in names]
        missing = [r for r in needed if not any(p in c for c in folded for p in roles[r])]
        if not header:
            rejected.append((file, "no header", None))
        elif len(set(folded)) < len(folded):
            rejected.append((file, "repeated column name", None))
        elif missing:
            rejected.append((file, "no column named like " + " or ".join(roles[missing[0]]), None))
        else:
            groups.setdefault(tuple(names), []).append(file)
    quarantine = spark.createDataFrame(rejected, "path string, reason string, line string")
    frames = []
    for names, files in sorted(groups.items()):
        schema = ", ".join(f"`{c}` string" for c in (*names, MALFORMED))
        read = (spark.read.schema(schema).option("sep", sep).option("header", "true")
                .option("enforceSchema", "true").option("mode", "PERMISSIVE")
                # Rows are judged by all columns of their header, whichever are asked for.
                .option("columnPruning", "false")
                .option("columnNameOfCorruptRecord", MALFORMED).csv(files))
        source = F.col("_metadata.file_path")
        # Always true; keeps a count from asking for the malformed text alone, which Spark refuses.
        asked = F.length(F.concat_ws("", F.col(f"`{names[0]}`"))) >= 0
        bad = read.where(F.col(MALFORMED).isNotNull() & asked)
        quarantine = quarantine.union(bad.select(
            source, F.lit("malformed row"), F.col(MALFORMED)))
        rows = read.where(F.col(MALFORMED).isNull() & asked).withColumns(
            {"source_path": source, "source_file": F.col("_metadata.file_name")}).drop(MALFORMED)
        rows = normalize_columns(rows)
        own = rows.select(*[c for c in rows.columns if not c.startswith("source_")])
        found = {r: find_column(own, *parts) for r, parts in roles.items()}
        frames.append(rows.withColumns({role(r): F.col(f"`{c}`") if c else F.lit(None).cast("string")
                                        for r, c in found.items()})
                      .drop(*[found[r] for r in moved if found.get(r)]))
    return (union_by_name(*frames) if frames else None), quarantine


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header CSV with one common layout; all columns as text."""
    return spark.read.option("sep", sep).option("header", "true").csv(path)


__all__ = ["find_column", "header_groups", "read_csv", "read_process_csv", "role"]
