"""Rows of a stream in event-time order, each with the rows of its key before it.

State is kept in two steps, for many keys at a time: a call of Python for every key would cost far
more than its rows. Keys are dealt into buckets. The first step holds rows by bucket and span of
time; when the watermark has passed the span's end, a timer gives its rows out in order. All rows
but the first ``size - 1`` of a key and span find the rows before them in their own span and leave
in blocks. The second step hands over between the spans of a bucket's keys: it gets the first and
the last ``size - 1`` rows of each key and span only, and holds the last ``size - 1`` rows of each
key. So a key with most of the rows is spread over as many state partitions as it has spans, and no
call and no state value holds all of it.

A block is an Arrow stream of pieces, told apart by the column ``PIECE``. The rows of a piece are
one key's, in order; those with ``OWN`` come out, and those before them are what they look back on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Spark reads a processor's state names in a Python process beside the driver, which has no other
# way to find this package: processors travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a key that one block releases, and that one state value holds.
BLOCK_ROWS = 8_192
# Parts that keys are dealt into. A call holds the rows of one and a span; a running query keeps its number.
BUCKETS = 256
# Marks the row that ends a finite stream, and its time: pandas has no later year.
END, LAST = "__end", "2262-01-01 00:00:00"
# Part of a bucket that hands over between its spans; blocks that need no more rows have other parts.
EDGE = -1
# Columns of blocks: the number of a row's piece, and whether the row comes out.
PIECE, OWN = "__piece", "__own"


def dump(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def load(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def _instant(ms: int) -> pd.Timestamp:
    return pd.Timestamp(ms, unit="ms")


def bucket(by: Sequence[str], buckets: int) -> Column:
    """The part that a key is dealt into. Keys with nulls are by themselves, so that others keep their types."""
    null = F.lit(False)
    for c in by:
        null |= F.col(c).isNull()
    return F.when(null, -1).otherwise(F.pmod(F.xxhash64(*by, F.lit(0)), F.lit(buckets))).cast("int")


def key_numbers(rows: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    """A number for each row's key."""
    return rows.groupby(list(by), dropna=False, sort=False).ngroup().to_numpy() if by else np.zeros(len(rows), int)


class _Ordered:
    """Rows of some keys by key and order, and where their keys and stretches without a pause begin."""

    def __init__(self, rows: pd.DataFrame, by: Sequence[str], order_by: Sequence[str], idle_us: int | None):
        rows = rows.assign(__key=key_numbers(rows, by)).sort_values(["__key", *order_by], kind="stable", ignore_index=True)
        keys = rows.pop("__key").to_numpy()
        self.rows, self.at, self.times = rows, np.arange(len(rows)), _micros(rows[order_by[0]])
        new = np.r_[True, np.diff(keys) != 0]
        self.first = self._begins(new)
        self.last = np.r_[np.flatnonzero(new)[1:], len(rows)][np.cumsum(new) - 1] - 1
        if idle_us is not None:
            new[1:] |= np.diff(self.times) > idle_us
        self.start = self._begins(new)

    def _begins(self, new: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(new, self.at, 0))

    def tails(self, before: int) -> np.ndarray:
        """The last rows of each key, as far as the next row of the key may look back on them."""
        return (self.last - self.at < before) & (self.start == self.start[self.last])

    def blocks(self, own: np.ndarray, before: int) -> Iterator[bytes]:
        """The rows ``own`` in blocks, after up to ``before`` rows of their stretch before them."""
        at = np.flatnonzero(own)
        if not len(at):
            return
        number = np.arange(len(at))
        new = np.r_[True, (np.diff(at) > 1) | (np.diff(self.start[at]) != 0)]
        new |= (number - np.maximum.accumulate(np.where(new, number, 0))) % BLOCK_ROWS == 0
        begins, ends = at[new], at[np.r_[np.flatnonzero(new)[1:], len(at)] - 1] + 1
        since = np.maximum(self.start[begins], begins - before)
        sizes, leads = ends - since, begins - since
        filled = (np.cumsum(sizes) - sizes) // BLOCK_ROWS
        cuts = [0, *np.flatnonzero(np.diff(filled)) + 1, len(sizes)]
        for lo, hi in zip(cuts, cuts[1:]):
            n = sizes[lo:hi]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            taken = self.rows.take(np.repeat(since[lo:hi], n) + within)
            yield dump(taken.assign(**{PIECE: np.repeat(np.arange(hi - lo), n),
                                       OWN: within >= np.repeat(leads[lo:hi], n)}))


class _Spans(StatefulProcessor):
    """Rows of one bucket and span, until the watermark has passed the span."""

    def __init__(self, by: Sequence[str], order_by: Sequence[str], kept: Sequence[str], size: int, span_us: int,
                 idle_us: int | None):
        self.by, self.order_by, self.kept = list(by), list(order_by), list(kept)
        self.size, self.span_us, self.idle_us = size, span_us, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "block binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if pd.isna(key[-1]):
            return
        for frame in rows:
            for at in range(0, len(frame), BLOCK_ROWS):
                self.rows.appendValue((dump(frame[self.kept].iloc[at:at + BLOCK_ROWS]),))
        self.handle.registerTimer(-(-(int(key[-1]) + 1) * self.span_us // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [load(block) for block, in self.rows.get()]
        self.rows.clear()
        if not held:
            return
        rows, before = _Ordered(pd.concat(held, ignore_index=True), self.by, self.order_by, self.idle_us), self.size - 1
        now = _instant(timerValues.getCurrentWatermarkInMs())
        # Only a key's first stretch in the span goes on from the span before it.
        first = (rows.start == rows.first) & (rows.at - rows.start < before)
        made = enumerate(rows.blocks(~first, before))
        edges = first | rows.tails(before)
        if edges.any():
            made = chain(made, [(EDGE, dump(rows.rows[edges].assign(**{OWN: first[edges]})))])
        for part, block in made:
            yield pd.DataFrame([[key[0], part, key[-1], block, now]], columns=["bucket", "part", "span", "rows", "at"])


class _Handover(StatefulProcessor):
    """First rows of keys and spans after the last rows before them; other blocks pass."""

    def __init__(self, by: Sequence[str], order_by: Sequence[str], size: int, span_us: int, idle_us: int | None):
        self.by, self.order_by, self.size, self.span_us, self.idle_us = list(by), list(order_by), size, span_us, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.before = handle.getListState("before", "block binary")

    def _keep(self, tails: pd.DataFrame, last: np.ndarray, watermark_ms: int) -> None:
        """Hold the last rows of keys, whose last times are ``last``, as long as a row can go on from them."""
        if self.idle_us is not None:
            # The row that goes on from them may still be held by its span.
            ends = ((last + self.idle_us) // self.span_us + 1) * self.span_us // 1000 + 2
            tails, ends = tails[ends > watermark_ms], ends[ends > watermark_ms]
            if len(ends):
                self.handle.registerTimer(int(ends.min()))
        if len(tails):
            self.before.put([(dump(tails.iloc[at:at + BLOCK_ROWS]),) for at in range(0, len(tails), BLOCK_ROWS)])
        else:
            self.before.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[-1] != EDGE:
            for frame in rows:
                yield frame[["rows"]]
            return
        edges = pd.concat(list(rows), ignore_index=True).sort_values("span", kind="stable")
        held = [load(block).assign(**{OWN: False}) for block, in self.before.get()]
        both = pd.concat([*held, *map(load, edges["rows"])], ignore_index=True)
        ordered = _Ordered(both, self.by, self.order_by, self.idle_us)
        own, before = ordered.rows.pop(OWN).to_numpy(bool), self.size - 1
        for block in ordered.blocks(own, before):
            yield pd.DataFrame({"rows": [block]})
        tails = ordered.tails(before)
        self._keep(ordered.rows[tails], ordered.times[ordered.last[tails]], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [load(block) for block, in self.before.get()]
        if held:
            ordered = _Ordered(pd.concat(held, ignore_index=True), self.by, self.order_by, None)
            self._keep(ordered.rows, ordered.times[ordered.last], timerValues.getCurrentWatermarkInMs())
        yield from ()


def released(stream: DataFrame, by: Sequence[str], order_by: Sequence[str], columns: Sequence[str], size: int,
             late: str, span_ms: int, expire_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``rows``: blocks of rows in event-time order, after up to ``size - 1`` rows of their key before them.

    A row comes out once, when the watermark has passed its span of ``span_ms``. The rows of a span
    and one of ``buckets`` parts of the keys are sorted in one call, so both bound memory; they do
    not influence results. After a pause of more than ``expire_ms`` a key starts anew.
    """
    kept = list(dict.fromkeys([*by, *order_by, *columns]))
    time, types = order_by[0], {f.name: f.dataType.simpleString() for f in stream.schema}
    if types[time] != "timestamp":
        raise ValueError(f"{time} must be a timestamp")
    idle_us = None if expire_ms is None else expire_ms * 1000
    us = F.unix_micros(time)
    span = ((us - F.pmod(us, F.lit(span_ms * 1000))) / F.lit(span_ms * 1000)).cast("bigint")
    if END in stream.columns:
        span = F.when(~F.col(END), span)
    rows = (stream.where(F.col(time).isNotNull()).withWatermark(time, late)
            .select(*kept, bucket(by, buckets).alias("__bucket"), span.alias("__span")))
    spans = rows.groupBy("__bucket", "__span").transformWithStateInPandas(
        _Spans(by, order_by, kept, size, span_ms * 1000, idle_us),
        "bucket int, part int, span bigint, rows binary, at timestamp", "append", "EventTime",
        eventTimeColumnName="at")
    return spans.groupBy("bucket", "part").transformWithStateInPandas(
        _Handover(by, order_by, size, span_ms * 1000, idle_us), "rows binary", "append", "EventTime")


def released_blocks(stream: DataFrame, by: Sequence[str], order_by: Sequence[str], columns: Sequence[str], size: int,
                    late: str, span_ms: int, expire_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``by``, ``lead``, ``rows``: the pieces of ``released``, each in a row, ``lead`` rows of it to look back on.

    ``rows`` is an Arrow stream of the columns ``order_by`` and ``columns``.
    """
    keys, kept = list(by), list(dict.fromkeys([*order_by, *columns]))
    types = {f.name: f.dataType.simpleString() for f in stream.schema}

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame["rows"]:
                yield pd.DataFrame([[*(piece[c].iloc[0] for c in keys), int((~piece[OWN]).sum()), dump(piece[kept])]
                                    for _, piece in load(block).groupby(PIECE)], columns=[*keys, "lead", "rows"])

    return released(stream, by, order_by, columns, size, late, span_ms, expire_ms, buckets).mapInPandas(
        split, "".join(f"`{c}` {types[c]}, " for c in by) + "lead int, rows binary")
