"""Faults that are triggered while the rows run: a stream of faults joined to a stream of rows.

A fault acts on the rows of its key from its time on, for ``STREAM_STEPS`` steps of a fixed length.
Both streams have a watermark of their own, so each may be out of order within its bound, and the
result does not depend on which of them is read first. A row comes out once both watermarks have
passed it; a source of faults therefore has to send something (a fault of type null will do) for
time to go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.stress import STREAM_DRIFT_RATE, STREAM_FAULTS, STREAM_SPIKE, STREAM_STEPS
from millrace.streaming.history import END, LAST


def inject_live(stream: DataFrame, faults: DataFrame, by: Sequence[str], order_by: Sequence[str],
                features: Sequence[str], late: str, faults_late: str, step_seconds: int, salts: int = 8) -> DataFrame:
    """``stream`` with the faults of a second stream (``by``, ``at``, ``type``, ``sensor`` index) and ``fault``.

    ``order_by`` begins with the event time and identifies a row of its key; rows that it does not
    tell apart come out as one. Of several faults that act on a row the latest wins, of equal times
    the one with the larger type, then sensor. Rows of a key are dealt out to ``salts`` parts, to
    which its faults are repeated, so a key with most of the rows is not joined by one task. Rows
    and faults without a time, and faults of an unknown type, are left out; values are not clipped.
    """
    ts, keys = order_by[0], [f"__by{i}" for i in range(len(by))]
    last = F.lit(LAST).cast("timestamp")
    rows = (stream.where(F.col(ts).isNotNull()).withWatermark(ts, late)
            .withColumn("__salt", F.pmod(F.xxhash64(*order_by), F.lit(salts)).cast("int")))
    # Conditions name the time, so that Spark checks them above the watermark: a row that holds
    # nothing but a time has to reach it.
    own = lambda c: F.when(F.col("at") < last, F.col(c))
    known = (faults.where(F.col("at").isNotNull()).withWatermark("at", faults_late)
             .select(*[own(c).alias(k) for c, k in zip(by, keys)], F.col("at").alias("__at"),
                     own("type").alias("__type"), own("sensor").alias("__sensor"))
             .where(F.col("__type").isin(*STREAM_FAULTS))
             .withColumn("__fault_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    lasts = F.make_dt_interval(secs=F.lit((STREAM_STEPS + 1) * step_seconds))
    acts = (F.col("__salt") == F.col("__fault_salt")) & (F.col(ts) >= F.col("__at")) & (F.col(ts) < F.col("__at") + lasts)
    for c, k in zip(by, keys):
        acts &= F.col(c) == F.col(k)
    fault = F.when(F.col("__at").isNotNull(), F.struct("__at", "__type", "__sensor"))
    kept = [c for c in stream.columns if c != END]
    groups = list(dict.fromkeys([*by, *order_by]))
    latest = rows.join(known, acts, "left").groupBy(*groups).agg(
        F.max(fault).alias("__fault"), *[F.first(c).alias(c) for c in kept if c not in groups])
    steps = F.floor((F.unix_micros(ts) - F.unix_micros("__fault.__at")) / F.lit(step_seconds * 1_000_000))
    kind, changed = F.col("__fault.__type"), {}
    for i, c in enumerate(features):
        here = F.coalesce(F.col("__fault.__sensor") == i, F.lit(False))
        changed[c] = (F.when(here & (kind == "spike"), F.col(c) + STREAM_SPIKE)
                      .when(here & (kind == "drift"), F.col(c) + steps * STREAM_DRIFT_RATE)
                      .when(here & (kind == "freeze"), F.lit(0.0)).otherwise(F.col(c)))
    out = latest.withColumns({**changed, "fault": kind}).select(*kept, "fault")
    return out.where(F.col(ts) < last) if END in stream.columns else out
