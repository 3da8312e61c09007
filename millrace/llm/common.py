"""Helpers shared by the corpus operators: written intermediate tables and word fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> SparkSession:
    """Let at most ``rows`` rows go to Python at a time: rows are whole texts, which both sides hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of a task, none empty: bounds what its Python objects take.

    In the end, memory that Arrow holds in reserve goes back, as workers live on.
    """
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class WordHashes(dict):
    """Word (bytes) to the 8 bytes of its hash. Holds at most ``limit`` words."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[word] = digest = xxhash.xxh3_64_digest(word)
        return digest


def ascii_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and 0x09-0x0D, with A-Z in lower case."""
    return text.lower().split()


def shingle_set(words: list[bytes], hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words.

    Fewer words make one shingle of the whole sequence; no words make none.
    """
    if not words:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(b"".join(map(hashes.__getitem__, words)), "<u8")
    size = min(width, len(codes))
    factor = np.uint64(0x9E3779B97F4A7C15)
    total = np.full(len(codes) - size + 1, np.uint64(size))
    for i in range(size):
        total = total * factor + codes[i:len(codes) - size + 1 + i]
    return np.unique(mix(total))
