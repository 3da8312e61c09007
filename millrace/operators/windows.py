"""Sliding windows over series. No window crosses a series; hot series are cut in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from millrace.operators.ordered import POSITION, ROWS_PER_TASK, per_series
from millrace.session import scratch_path

# Matrices that are added up by one task, and how they travel.
FAN_IN = 16
MATRIX = "task int, matrix binary"
# Windows handed to a numpy function at a time: bounds the memory of a worker.
WINDOWS_PER_CALL = 2_048


def _frame(keys: Sequence[str], order_by: Sequence[str], size: int):
    # The same partitioning and order as the numbering, so nothing is sorted twice.
    return Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(1 - size, 0)


def _keyed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    for c in by:
        df = df.filter(F.col(c).isNotNull())
    return df


def sliding_windows(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                    columns: Sequence[str], size: int, stride: int = 1,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per full window: key, ``window_id``, ``start_ts``, ``end_ts``, array ``steps``.

    A series of n rows has n - size + 1 windows (none if it is shorter); with a
    stride, windows start at rows 0, stride, 2 * stride, ... of the series. Rows
    without a key belong to no series. Each row is repeated ``size`` times, so
    prefer ``map_windows`` when only a result per window is needed.
    """
    ts = order_by[0]

    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        frame = _frame(keys, order_by, size)
        start = F.col(POSITION) - size
        return (rows.select(*dict.fromkeys([*keys, POSITION, *order_by, *columns]))
                .withColumns({"steps": F.collect_list(F.struct(*columns)).over(frame),
                              "start_ts": F.first(ts).over(frame)})
                .filter((start >= 0) & (start % stride == 0))
                .select(*keys, POSITION, start.alias("window_id"), "start_ts",
                        F.col(ts).alias("end_ts"), "steps"))

    return per_series(_keyed(df, by), by, order_by, size - 1, compute, rows_per_task).drop(POSITION)


def freeze_flag(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                columns: Sequence[str], size: int, epsilon: float = 1e-4,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``is_freeze``: some feature is flat over the window that ends in this row.

    Flat means a population standard deviation below ``epsilon``. Rows before the
    first full window get null.
    """
    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        frame = _frame(keys, order_by, size)
        flat = F.lit(False)
        for c in columns:
            complete = F.count(c).over(frame) == size
            flat = flat | (complete & (F.stddev_pop(c).over(frame) < epsilon))
        return rows.withColumn("is_freeze", F.when(F.col(POSITION) >= size, flat))

    return per_series(_keyed(df, by), by, order_by, size - 1, compute, rows_per_task).drop(POSITION)


def rolling_history(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                    columns: Sequence[str], n: int = 100,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``<column>_history``: the last up to ``n`` values, oldest first."""
    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        frame = _frame(keys, order_by, n)
        lists = F.collect_list(F.struct(*columns)).over(frame)
        listed = rows.withColumn("__history", lists)
        return listed.withColumns({f"{c}_history": F.col("__history")[c] for c in columns}
                                  ).drop("__history")

    return per_series(_keyed(df, by), by, order_by, n - 1, compute, rows_per_task).drop(POSITION)


def padded_windows(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str], size: int,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``steps``: a window for every row, left-padded with the oldest row seen."""
    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        seen = rows.withColumn("__seen", F.collect_list(F.struct(*columns)).over(_frame(keys, order_by, size)))
        pad = F.array_repeat(F.element_at("__seen", 1), F.lit(size) - F.size("__seen"))
        return seen.withColumn("steps", F.concat(pad, F.col("__seen"))).drop("__seen")

    return per_series(_keyed(df, by), by, order_by, size - 1, compute, rows_per_task).drop(POSITION)


def rolling_mean(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                 columns: Sequence[str], n: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``<column>_mean`` over the last up to ``n`` rows and the row's ``position``."""
    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        frame = _frame(keys, order_by, n)
        return rows.withColumns({f"{c}_mean": F.avg(c).over(frame) for c in columns})

    return per_series(df, by, order_by, n - 1, compute,
                      rows_per_task).withColumnRenamed(POSITION, "position")


def iter_windows(frames: Iterator[pd.DataFrame], columns: Sequence[str], size: int,
                 stride: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(last rows, windows[n, size, features]) from rows sorted by series and position.

    Arrow batches may cut a series anywhere: the last ``size - 1`` rows are kept
    for the next batch. A row ends a window when its index in the series (or
    block) is at least ``size``; then the rows before it belong to the same series.
    """
    kept, tail = size - 1, None
    for frame in frames:
        fresh = 0 if tail is None else len(tail)
        if fresh:
            frame = pd.concat([tail, frame], ignore_index=True)
        tail = frame.iloc[max(0, len(frame) - kept):]
        if len(frame) < size:
            continue
        values = frame[list(columns)].to_numpy(dtype=float)
        views = np.lib.stride_tricks.sliding_window_view(values, size, axis=0)
        usable = ((frame["__index"].to_numpy() >= size)
                  & ((frame[POSITION].to_numpy() - size) % stride == 0))
        usable[:fresh] = False
        ends = np.flatnonzero(usable)
        for at in range(0, len(ends), WINDOWS_PER_CALL):
            part = ends[at:at + WINDOWS_PER_CALL]
            yield frame.iloc[part], views[part - kept].transpose(0, 2, 1)


def _sorted_rows(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 columns: Sequence[str]) -> DataFrame:
    """Rows clustered by series and sorted: a no-op on rows that come from a series window."""
    return (rows.select(*dict.fromkeys([*keys, POSITION, "__index", *order_by, *columns]))
            .sortWithinPartitions(*keys, *order_by))


def map_windows(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                columns: Sequence[str], size: int,
                score: Callable[[np.ndarray], dict], result: str, stride: int = 1,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Key, ``window_id``, ``end_ts`` and the columns ``score`` returns for each full window.

    ``score`` maps an array [n, size, features] to columns of length n, typed by
    the DDL string ``result``. Windows are views on the sorted rows and are never
    written out.
    """
    ts = order_by[0]
    names = StructType.fromDDL(result).names

    def run(frames: Iterator[pd.DataFrame], keys=(*by, "__block")) -> Iterator[pd.DataFrame]:
        for last, windows in iter_windows(frames, columns, size, stride):
            out = last[[*keys, POSITION]].reset_index(drop=True)
            out["window_id"] = out[POSITION] - size
            out["end_ts"] = last[ts].to_numpy()
            scored = score(windows)
            for name in names:
                out[name] = scored[name]
            yield out

    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        types = {f.name: f.dataType.simpleString() for f in rows.schema}
        ddl = ", ".join([*[f"`{k}` {types[k]}" for k in (*keys, POSITION)],
                         "window_id bigint", f"end_ts {types[ts]}", result])
        return _sorted_rows(rows, keys, order_by, columns).mapInPandas(run, ddl)

    return per_series(_keyed(df, by), by, order_by, size - 1, compute, rows_per_task).drop(POSITION)


def window_moments(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str], size: int, shift: Sequence[float], stride: int = 1,
                   rows_per_task: int = ROWS_PER_TASK) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, sum and cross-product matrix of the flattened windows, minus ``shift`` per feature.

    Every task adds up its own windows and emits one matrix. Matrices are added whole, up to
    ``FAN_IN`` at a time, in a tree. Only the (size * features)^2 result reaches the driver.
    """
    width = size * len(columns)
    shift = np.asarray(shift, dtype=float)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width + 1))
        for last, windows in iter_windows(frames, columns, size, stride):
            own = last["__own"].to_numpy()
            flat = (windows[own] - shift).reshape(int(own.sum()), width)
            flat = flat[~np.isnan(flat).any(axis=1)]
            flat = np.hstack([np.ones((len(flat), 1)), flat])
            total += flat.T @ flat
        if total[0, 0]:
            yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "matrix": [total.tobytes()]})

    def compute(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        marked = _sorted_rows(rows, keys, order_by, [*columns, "__own"])
        return marked.mapInPandas(run, MATRIX).withColumns(
            {"__block": F.lit(0).cast("bigint"), POSITION: F.lit(1).cast("bigint")})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m) for m in frame["matrix"])
        return pd.DataFrame({"task": frame["task"].iloc[:1] // FAN_IN, "matrix": [total.tobytes()]})

    parts = per_series(_keyed(df, by), by, order_by, size - 1, compute, rows_per_task,
                       drop_repeated=False).select("task", "matrix")
    path = scratch_path(df.sparkSession, "moments")
    parts.write.parquet(path)
    parts = df.sparkSession.read.parquet(path)
    # A number may stand for two tasks, as cold and hot series are stages of their own.
    groups = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while groups > 1:
        parts = parts.groupBy(F.floor(F.col("task") / FAN_IN).alias("__group")).applyInPandas(add, MATRIX)
        groups = -(-groups // FAN_IN)
    matrix = np.zeros((width + 1, width + 1))
    for row in parts.collect():
        matrix += np.frombuffer(row["matrix"]).reshape(matrix.shape)
    return int(round(matrix[0, 0])), matrix[0, 1:], matrix[1:, 1:]
