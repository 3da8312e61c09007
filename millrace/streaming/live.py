"""Live scoring with Structured Streaming, by event time.

Rows of a key may arrive in any order within ``late``; results do not depend on how they are
dealt out to micro-batches. ``history.released`` holds rows back until the watermark has
passed them and gives them out in event-time order, with the rows before them that their windows
reach back to; its state is split by key and time, so no key is bound to one task. Scoring is a
stage of its own, over blocks dealt out anew.

Rows that the watermark has not passed when a stream stops stay in its state and are released
when the stream goes on; ``replay`` runs a finite stream to its end and releases all of them. Rows
older than the watermark, and rows without a time, are left out; ``late`` has no default, so
nothing is dropped by accident.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.windows import WINDOWS_PER_CALL
from millrace.streaming.history import BUCKETS, END, LAST, OWN, PIECE, load, released

# Bound on the files of one micro-batch. It does not influence results.
BYTES_PER_TRIGGER = 1 << 30
# Rows come out when their span of time has passed; it does not influence results.
SPAN_MS = 60_000


def stream_layer(spark: SparkSession, path: str, schema: StructType | str, glob: str = "*.parquet",
                 max_bytes: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Files of a Parquet layer as a stream, in bounded micro-batches."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxBytesPerTrigger", str(max_bytes)).parquet(path))


def _sink(stream: DataFrame, path: str) -> DataStreamWriter:
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint"))


def state_partitions(spark: SparkSession) -> int:
    """As many parts of state as cores, if the session does not have fewer partitions.

    Each micro-batch starts a Python process and opens and commits a store for every part and
    step of state, with or without rows in it. Calls hold a bucket and span, so memory does not
    depend on the number of parts.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, spark.sparkContext.defaultParallelism))


def scoring_partitions(spark: SparkSession) -> int:
    """Three times as many parts as those of state, if the session does not have fewer partitions.

    Each micro-batch starts Python and opens a file for every part, with or without blocks in it. A
    part scores its blocks one by one, so memory does not depend on the number of parts.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * state_partitions(spark))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """A query takes over its session's settings when it starts."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _start(writer: DataStreamWriter, spark: SparkSession, partitions: int | None, ends: bool = True) -> StreamingQuery:
    """A query's checkpoint keeps the number of its parts of state; ``partitions`` holds for new ones."""
    with _settings(spark, {"spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)),
                           "spark.sql.streaming.noDataMicroBatches.enabled": str(ends).lower()}):
        return writer.start()


def drain(stream: DataFrame, path: str, partitions: int | None = None, ends: bool = True) -> DataFrame:
    """Write what is available to Parquet below ``path`` and return all that was written there.

    Without ``ends``, what the last watermark releases is left to the next run.
    """
    spark = stream.sparkSession
    _start(_sink(stream, path).trigger(availableNow=True), spark, partitions, ends).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def run(stream: DataFrame, path: str, every: str = "500 milliseconds", partitions: int | None = None) -> StreamingQuery:
    """Keep writing to Parquet below ``path``, one micro-batch per interval, until stopped."""
    return _start(_sink(stream, path).trigger(processingTime=every), stream.sparkSession, partitions)


def replay(source: DataFrame, time: str, build: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Run ``build(source)`` over a finite source to its end and return all that it wrote.

    Once everything is read, one more row with a late ``time`` moves the watermark past all rows,
    so that none is held back. ``build`` gets the source with that row in it, told apart by the
    column ``END``, which the operators of this package know; it holds no data.
    """
    return replay_all({"source": (source, time)}, build, path)


def replay_all(sources: dict[str, tuple[DataFrame, str]], build: Callable[..., DataFrame], path: str) -> DataFrame:
    """``replay`` of several finite sources, each with its time column, as arguments of ``build``."""
    marks, streams = {}, []
    for name, (source, time) in sources.items():
        marks[name] = source.sparkSession.range(1).select(F.lit(LAST).cast("timestamp").alias(time), F.lit(True).alias(END))
        marks[name].limit(0).write.parquet(f"{path}/end-{name}")
        ends = source.sparkSession.readStream.schema(marks[name].schema).parquet(f"{path}/end-{name}")
        streams.append(source.withColumn(END, F.lit(False)).unionByName(ends, allowMissingColumns=True))
    stream = build(*streams)
    drain(stream, path, ends=False)
    for name, mark in marks.items():
        mark.write.mode("append").parquet(f"{path}/end-{name}")
    return drain(stream, path)


def _scored(blocks: DataFrame, stream: DataFrame, by: Sequence[str], order_by: Sequence[str],
            result: str, each: Callable[[pd.DataFrame, np.ndarray, np.ndarray], Iterator[pd.DataFrame]]) -> DataFrame:
    """``each(rows, start, own)`` on every block: the rows ``own``, whose pieces begin with the rows ``start``."""
    types = {f.name: f.dataType.simpleString() for f in stream.schema}
    keys = list(dict.fromkeys([*by, *order_by]))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame["rows"]:
                rows = load(block)
                begins = np.flatnonzero(np.r_[True, np.diff(rows[PIECE]) != 0])
                own = np.flatnonzero(rows[OWN])
                yield from each(rows, begins[rows[PIECE].to_numpy()[own]], own)

    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keys], result])
    dealt = blocks.withColumn("deal", F.xxhash64("rows")).repartition(scoring_partitions(stream.sparkSession), "deal")
    return dealt.mapInPandas(score, schema)


def ring_buffer(stream: DataFrame, by: Sequence[str], order_by: Sequence[str],
                columns: Sequence[str], size: int, score: Callable[[np.ndarray], dict],
                result: str, late: str, pad: bool = True, expire_ms: int | None = None,
                span_ms: int = SPAN_MS, buckets: int = BUCKETS) -> DataFrame:
    """Score, for every row, the window of the last ``size`` rows of its key.

    ``order_by`` begins with the event time (a timestamp) and should identify a row of the
    key. A window that is not full yet is padded on the left with the oldest row, or with
    ``pad=False`` left out. ``score`` maps [n, size, features] to columns. After a pause of
    more than ``expire_ms`` a key starts anew. ``span_ms``, ``buckets``: as in ``released``.
    """
    names, keys, columns = StructType.fromDDL(result).names, list(dict.fromkeys([*by, *order_by])), list(columns)

    def each(rows: pd.DataFrame, start: np.ndarray, own: np.ndarray) -> Iterator[pd.DataFrame]:
        values, before = rows[columns].to_numpy(dtype=float), size - 1
        if pad:
            # The first own row of a piece needs the most rows before it.
            pieces, first = np.unique(start, return_index=True)
            repeats = np.ones(len(rows), int)
            repeats[pieces] += np.maximum(0, before - (own - start)[first])
            values, ends = np.repeat(values, repeats, axis=0), (np.cumsum(repeats) - 1)[own]
        else:
            own = ends = own[own - start >= before]
        if not len(own):
            return
        views = np.lib.stride_tricks.sliding_window_view(values, size, axis=0)
        for at in range(0, len(own), WINDOWS_PER_CALL):
            out = rows[keys].iloc[own[at:at + WINDOWS_PER_CALL]].reset_index(drop=True)
            scored = score(views[ends[at:at + WINDOWS_PER_CALL] - before].transpose(0, 2, 1))
            yield out.assign(**{name: scored[name] for name in names})

    blocks = released(stream, by, order_by, columns, size, late, span_ms, expire_ms, buckets)
    return _scored(blocks, stream, by, order_by, result, each)


def rolling_values(stream: DataFrame, by: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str], late: str, n: int = 100, expire_ms: int | None = None,
                   span_ms: int = SPAN_MS, buckets: int = BUCKETS) -> DataFrame:
    """The last ``n`` values of every column up to each row; fewer for a key's first rows."""
    keys = list(dict.fromkeys([*by, *order_by]))

    def each(rows: pd.DataFrame, start: np.ndarray, own: np.ndarray) -> Iterator[pd.DataFrame]:
        since, values = np.maximum(start, own - n + 1), {c: rows[c].to_numpy(dtype=float) for c in columns}
        for at in range(0, len(own), WINDOWS_PER_CALL):
            stop = min(len(own), at + WINDOWS_PER_CALL)
            out = rows[keys].iloc[own[at:stop]].reset_index(drop=True)
            spans = list(zip(since[at:stop].tolist(), (own[at:stop] + 1).tolist()))
            yield out.assign(**{f"{c}_history": [v[i:j] for i, j in spans] for c, v in values.items()})

    result = ", ".join(f"{c}_history array<double>" for c in columns)
    blocks = released(stream, by, order_by, columns, n, late, span_ms, expire_ms, buckets)
    return _scored(blocks, stream, by, order_by, result, each)
