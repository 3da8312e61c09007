"""Sequences without a pause, on a stream: the state is the open ones of each key.

Rows are first merged by key and second in the scan's task, so a key with most of the rows reaches
its state as a fraction of them. The state holds first time, last time and rows of the sequences
that a row may still join, whatever order rows arrive in; a timer closes a sequence once the
watermark has passed it by more than the pause. Keys are dealt into buckets, and a call serves all
keys of one. Pauses are counted in whole seconds, as in
``split_sequences_by_gap``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.history import BLOCK_ROWS, BUCKETS, END, bucket, dump, key_numbers, load

# See ``history``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICROS = 1_000_000


def merged(spans: pd.DataFrame, by: Sequence[str], gap: int) -> pd.DataFrame:
    """Rows of a key with ``first``, ``last``, ``n``, joined where at most ``gap`` seconds lie between."""
    spans = spans.assign(__key=key_numbers(spans, by)).sort_values(["__key", "first"], kind="stable", ignore_index=True)
    keys, first, n = (spans[c].to_numpy() for c in ("__key", "first", "n"))
    latest = spans.groupby("__key")["last"].cummax().to_numpy()
    starts = np.flatnonzero(np.r_[True, (np.diff(keys) != 0) | (first[1:] // MICROS - latest[:-1] // MICROS > gap)])
    return spans[list(by)].take(starts).reset_index(drop=True).assign(
        first=first[starts], last=np.maximum.reduceat(spans["last"].to_numpy(), starts), n=np.add.reduceat(n, starts))


class _Open(StatefulProcessor):
    """The sequences of a bucket's keys that the watermark has not passed."""

    def __init__(self, by: Sequence[str], gap: int):
        self.by, self.gap = list(by), gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "spans binary")

    def _held(self) -> list[pd.DataFrame]:
        return [load(block) for block, in self.spans.get()]

    def _frame(self, spans: pd.DataFrame, late: bool) -> pd.DataFrame:
        times = [spans[c].to_numpy().astype("datetime64[us]") for c in ("first", "last")]
        return spans[self.by].assign(rows=spans["n"], start_ts=times[0], end_ts=times[1], late=late)

    def _closed(self, spans: list[pd.DataFrame], watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Keep what a row in time can still join, and give out the rest."""
        if not sum(map(len, spans)):
            return
        joined = merged(pd.concat([s for s in spans if len(s)], ignore_index=True), self.by, self.gap)
        open_ = (joined["last"] // MICROS + self.gap >= watermark_ms // 1000).to_numpy()
        if (~open_).any():
            yield self._frame(joined[~open_], False)
        kept = joined[open_]
        if len(kept):
            self.spans.put([(dump(kept.iloc[at:at + BLOCK_ROWS]),) for at in range(0, len(kept), BLOCK_ROWS)])
            self.handle.registerTimer(int(kept["last"].min() // MICROS + self.gap + 1) * 1000)
        else:
            self.spans.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        new = pd.concat([f[[*self.by, "first", "last", "n"]] for f in rows], ignore_index=True)
        # A row is late if the watermark has passed its whole second.
        late = ((new["first"] // MICROS + 1) * 1000 <= watermark).to_numpy() & (watermark > 0)
        if late.any():
            yield self._frame(new[late], True)
        yield from self._closed([*self._held(), new[~late]], watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._closed(self._held(), timerValues.getCurrentWatermarkInMs())


def sessions(stream: DataFrame, by: Sequence[str], ts: str, late: str, gap_seconds: int = 600,
             buckets: int = BUCKETS) -> DataFrame:
    """``by``, ``rows``, ``start_ts``, ``end_ts``, ``late``: sequences without a longer pause.

    A sequence comes out once, when the watermark has passed it. Rows that come after the
    watermark has passed their second come out by themselves, with ``late`` set, and join no
    sequence: the rows of both kinds add up to the rows that came in with a time. Rows without a
    time are left out. The open sequences of one of ``buckets`` parts of the keys meet in one call;
    the number does not influence results, and a running query keeps it.
    """
    by, types = list(by), {f.name: f.dataType.simpleString() for f in stream.schema}
    if types[ts] != "timestamp":
        raise ValueError(f"{ts} must be a timestamp")
    keys = "".join(f"`{c}` {types[c]}, " for c in by)
    ended = F.col(END) if END in stream.columns else F.lit(False)
    rows = (stream.where(F.col(ts).isNotNull()).withWatermark(ts, late)
            .select(*by, F.unix_micros(ts).alias("us"), ended.alias("ended")))

    def by_second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[~frame["ended"]]
            grouped = frame.groupby([*(frame[c] for c in by), frame["us"] // MICROS], dropna=False)["us"]
            out = grouped.agg(["min", "max", "size"])
            out.index.names = [*by, "second"]
            yield out.reset_index().rename(columns={"min": "first", "max": "last", "size": "n"})[[*by, "first", "last", "n"]]

    partial = rows.mapInPandas(by_second, keys + "first bigint, last bigint, n bigint")
    return partial.withColumn("__bucket", bucket(by, buckets)).groupBy("__bucket").transformWithStateInPandas(
        _Open(by, gap_seconds), keys + "rows bigint, start_ts timestamp, end_ts timestamp, late boolean",
        "append", "EventTime")
