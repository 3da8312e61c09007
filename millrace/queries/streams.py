"""Streaming operators, run over all files that are available."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.signals import health, status
from millrace.operators.detect.consensus import DETECTION_SCHEMA, TripleDetector
from millrace.operators.sequences import split_sequences_by_gap
from millrace.operators.stress import inject_stream
from millrace.queries.detectors import FIXED_DETECTION_SQL, fixed_detector, triple_models
from millrace.queries.registry import SIGNAL_ORDER, SIGNALS_SQL, query, signals, table
from millrace.queries.sequences import PADDED_SQL, SENSORS, USER
from millrace.session import scratch_path
from millrace.streaming import live
from millrace.streaming.faults import inject_live
from millrace.streaming.sessions import sessions


# Disorder that the streams allow for.
LATE = "10 minutes"
# Users have some rows a day, so a span of theirs is some days; it does not influence results.
SPAN_MS = 10 * 86_400_000


def stream_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signal table as a stream."""
    events = live.stream_layer(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                         "event_type", "value",
                         F.get_json_object("props", "$.k").cast("double").alias("k"))


@query("stream_scan", f"WITH {SIGNALS_SQL} SELECT event_id, CAST(us AS BIGINT) AS us, user_id, value, k FROM signals")
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_signals(spark, sf_dir).select(
        "event_id", F.unix_micros("ts").alias("us"), "user_id", "value", "k")
    return live.drain(rows, scratch_path(spark, "stream"))


def _summarise(windows: np.ndarray) -> dict:
    values = windows[:, :, 0]
    return {"steps": np.full(len(values), values.shape[1]), "first_value": values[:, 0],
            "last_value": values[:, -1], "mean": values.mean(axis=1)}


def replayed(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All that ``build`` makes of the signal stream, run to its end."""
    return live.replay(stream_signals(spark, sf_dir), "ts", build, scratch_path(spark, "stream"))


@query("stream_ring_buffer", PADDED_SQL)
def stream_ring_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The padded window of 60 rows, kept as keyed state."""
    found = replayed(spark, sf_dir, lambda rows: live.ring_buffer(
        rows, USER, SIGNAL_ORDER, ["value"], 60, _summarise,
        "steps bigint, first_value double, last_value double, mean double", LATE, span_ms=SPAN_MS))
    return found.select("event_id", "steps", "first_value", "last_value", F.round("mean", 4).alias("mean"))


@query("stream_history", f"""
WITH {SIGNALS_SQL},
framed AS (SELECT event_id, us, count(*) OVER w AS n, first_value(value) OVER w AS oldest, max(k) OVER w AS top_k
FROM signals
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
SELECT event_id, n, oldest, top_k FROM framed
""")
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 100 values of both sensors after each row."""
    # Only what is asked of the histories is written.
    return replayed(spark, sf_dir, lambda rows: live.rolling_values(
        rows, USER, SIGNAL_ORDER, SENSORS, LATE, 100, span_ms=SPAN_MS).select(
            "event_id", F.size("value_history").cast("bigint").alias("n"),
            F.element_at("value_history", 1).alias("oldest"), F.array_max("k_history").alias("top_k")))


@query("stream_inject", f"""
WITH {SIGNALS_SQL},
first AS (SELECT user_id, min(event_id) AS e FROM events GROUP BY user_id),
plan AS (SELECT user_id, e - e % 30 AS start, e % 2 AS sensor,
                CASE e % 3 WHEN 0 THEN 'spike' WHEN 1 THEN 'drift' ELSE 'freeze' END AS type FROM first),
planned AS (SELECT s.*, type, sensor, event_id - start AS elapsed,
                   event_id >= start AND event_id - start <= 40 AS active FROM signals s JOIN plan USING (user_id))
SELECT event_id, CASE WHEN active THEN type END AS fault,
       CASE WHEN active AND sensor = 0 THEN
         CASE type WHEN 'spike' THEN value + 0.5e0 WHEN 'drift' THEN value + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE value END AS value,
       CASE WHEN active AND sensor = 1 THEN
         CASE type WHEN 'spike' THEN k + 0.5e0 WHEN 'drift' THEN k + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE k END AS k
FROM planned
""")
def stream_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled faults joined to the stream; the event number is the step."""
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("e"))
    kind = F.when(F.col("e") % 3 == 0, "spike").when(F.col("e") % 3 == 1, "drift").otherwise("freeze")
    schedule = first.select("user_id", kind.alias("type"), (F.col("e") % 2).cast("int").alias("sensor"),
                            (F.col("e") - F.col("e") % 30).alias("start"))
    faulty = inject_stream(stream_signals(spark, sf_dir), schedule, USER, "event_id", SENSORS)
    return live.drain(faulty.select("event_id", "fault", *SENSORS), scratch_path(spark, "stream"))


# Faults are triggered by some events; a step of a fault is an hour.
LIVE_STEP = 3_600


@query("stream_inject_live", f"""
WITH {SIGNALS_SQL},
faults AS (SELECT user_id, us AS at, CASE event_id % 3 WHEN 0 THEN 'spike' WHEN 1 THEN 'drift' ELSE 'freeze' END AS type,
                  event_id % 2 AS sensor FROM signals WHERE event_id % 9 = 4),
acting AS (SELECT s.event_id, max((f.at, f.type, f.sensor)) AS f FROM signals s JOIN faults f
           ON s.user_id = f.user_id AND s.us >= f.at AND s.us < f.at + {41 * LIVE_STEP * 1_000_000} GROUP BY s.event_id),
planned AS (SELECT s.*, f[2] AS type, f[3] AS sensor, (us - f[1]) // {LIVE_STEP * 1_000_000} AS elapsed
            FROM signals s LEFT JOIN acting USING (event_id))
SELECT event_id, type AS fault,
       CASE WHEN sensor = 0 THEN
         CASE type WHEN 'spike' THEN value + 0.5e0 WHEN 'drift' THEN value + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE value END AS value,
       CASE WHEN sensor = 1 THEN
         CASE type WHEN 'spike' THEN k + 0.5e0 WHEN 'drift' THEN k + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE k END AS k
FROM planned
""")
def stream_inject_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults that come in as a stream of their own, in files without order."""
    kind = F.element_at(F.array(*map(F.lit, ("spike", "drift", "freeze"))), (F.col("event_id") % 3 + 1).cast("int"))
    triggered = signals(spark, sf_dir).where("event_id % 9 = 4").select(
        "user_id", F.col("ts").alias("at"), kind.alias("type"), (F.col("event_id") % 2).cast("int").alias("sensor"),
        F.pmod(F.xxhash64("event_id"), F.lit(4)).cast("int").alias("file"))
    path = scratch_path(spark, "faults")
    triggered.repartition("file").drop("file").write.parquet(path)
    faults = spark.readStream.schema("user_id bigint, at timestamp, type string, sensor int").parquet(path)
    found = live.replay_all(
        {"rows": (stream_signals(spark, sf_dir), "ts"), "faults": (faults, "at")},
        lambda rows, faults: inject_live(rows, faults, USER, SIGNAL_ORDER, SENSORS, LATE, "40 days", LIVE_STEP),
        scratch_path(spark, "stream"))
    return found.select("event_id", "fault", *SENSORS)


def _alerts(spark: SparkSession, sf_dir: str, detector: TripleDetector) -> DataFrame:
    return replayed(spark, sf_dir, lambda rows: live.ring_buffer(
        rows, USER, SIGNAL_ORDER, SENSORS, detector.size, detector, DETECTION_SCHEMA, LATE, pad=False, span_ms=SPAN_MS))


@query("stream_alerts")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three detectors on every full window of the stream, with status and health."""
    _, detector = triple_models(spark, sf_dir)
    return _alerts(spark, sf_dir, detector).select(
        "event_id", "user_id", F.unix_micros("ts").alias("end_us"), status(F.col("window_alert")).alias("status"),
        health(F.col("window_error")).alias("health"), "window_alert", "pca_alert", "iso_alert")


@query("stream_alerts_fixed", f"""
WITH {FIXED_DETECTION_SQL}
SELECT event_id, round(window_error, 5) AS window_error, window_error > 0.1 AS window_alert,
       round(sqrt(pca_score), 6) AS pca_score, pca_score > 0.05 AS pca_alert, round(iso_score, 8) AS iso_score,
       iso_score > 0 AS iso_alert, CASE WHEN window_error > 0.1 THEN 'ANOMALY' ELSE 'HEALTHY' END AS status
FROM detected
""")
def stream_alerts_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written-down detectors, with their scaler, on every full window of the stream."""
    return _alerts(spark, sf_dir, fixed_detector()).select(
        "event_id", F.round("window_error", 5).alias("window_error"), "window_alert",
        F.round(F.sqrt("pca_score"), 6).alias("pca_score"), "pca_alert", F.round("iso_score", 8).alias("iso_score"),
        "iso_alert", status(F.col("window_alert")).alias("status"))


SESSIONS_SQL = f"""
WITH {SIGNALS_SQL},
steps AS (SELECT *, CAST(floor(us / 1000000.0) AS BIGINT) - lag(CAST(floor(us / 1000000.0) AS BIGINT))
                    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM signals),
numbered AS (SELECT *, sum(CASE WHEN d <= 36000 THEN 0 ELSE 1 END)
                       OVER (PARTITION BY user_id ORDER BY ts) AS s FROM steps)
SELECT user_id, count(*) AS rows, CAST(min(us) AS BIGINT) AS start_us, CAST(max(us) AS BIGINT) AS end_us
FROM numbered GROUP BY user_id, s
"""


@query("session_sequences", SESSIONS_SQL)
def session_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in batch: rows are numbered by gap, so a hot user is cut in chunks."""
    rows = split_sequences_by_gap(signals(spark, sf_dir), "ts", 36000, ["event_id"], USER)
    us = F.unix_micros("ts")
    return rows.groupBy("user_id", "sequence_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(us).alias("start_us"), F.max(us).alias("end_us")
    ).drop("sequence_id")


@query("stream_sessions", SESSIONS_SQL)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the stream, closed by the watermark; no row is late."""
    found = replayed(spark, sf_dir, lambda rows: sessions(rows, USER, "ts", LATE, 36_000))
    return found.where("not late").select("user_id", "rows", F.unix_micros("start_ts").alias("start_us"),
                                          F.unix_micros("end_ts").alias("end_us"))
