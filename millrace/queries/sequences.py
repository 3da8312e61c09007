"""Sequence, window, ordering and sampling operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import sequences, windows
from millrace.operators.cleaning import drop_silence
from millrace.operators.sampling import sample_n
from millrace.queries.profiles import rounded
from millrace.queries.registry import (
    EJECTION, FRAGMENT, ORDER, ORDER_SQL, SIGNAL_ORDER, SIGNALS_SQL, SPEED, THICKNESS,
    query, signals, table,
)

USER, SENSORS = ["user_id"], ["value", "k"]


def _gap_sql(partition: str, seconds: int) -> str:
    return f"""
WITH {SIGNALS_SQL},
steps AS (SELECT *, CAST(floor(us / 1000000.0) AS BIGINT)
                    - lag(CAST(floor(us / 1000000.0) AS BIGINT)) OVER ({partition} ORDER BY ts, event_id) AS d
          FROM signals)
SELECT event_id, CAST(sum(CASE WHEN d <= {seconds} THEN 0 ELSE 1 END)
       OVER ({partition} ORDER BY ts) AS BIGINT) AS sequence_id FROM steps"""


@query("gap_split_global", _gap_sql("", 600))
def gap_split_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir).select("event_id", "ts")
    return sequences.split_sequences_by_gap(rows, "ts", 600, ["event_id"]).drop("ts")


@query("gap_split_by_batch", _gap_sql("PARTITION BY user_id", 36000))
def gap_split_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir).select("event_id", "ts", "user_id")
    split = sequences.split_sequences_by_gap(rows, "ts", 36000, ["event_id"], USER)
    return split.select("event_id", "sequence_id")


@query("gap_profile", f"""
WITH {SIGNALS_SQL},
gaps AS (SELECT (us - lag(us) OVER (ORDER BY ts, event_id)) / 1000000.0 AS g FROM signals)
SELECT count(g) AS count, round(avg(g), 4) AS mean, round(stddev_samp(g), 4) AS std, min(g) AS min,
       round(quantile_cont(g, 0.25), 4) AS q25, round(quantile_cont(g, 0.5), 4) AS q50,
       round(quantile_cont(g, 0.75), 4) AS q75, max(g) AS max
FROM gaps WHERE g > 60
""")
def gap_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of gaps above a minute."""
    from millrace.operators.profile import describe
    gaps = sequences.gap_profile(signals(spark, sf_dir), "ts", ["event_id"])
    stats = describe(gaps.filter(F.col("gap_seconds") > 60), "gap_seconds")
    return rounded(stats, ["mean", "std", "q25", "q50", "q75"])


WARM_SQL = f"""
active AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY {ORDER_SQL}) AS r
           FROM lineitem WHERE l_discount > 0)"""


def _process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*FRAGMENT, *ORDER, SPEED, EJECTION, THICKNESS)


@query("trim_warmup", f"""
WITH {WARM_SQL}
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey FROM active WHERE r > 90
""")
def trim_warmup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sequences.trim_warmup(drop_silence(_process(spark, sf_dir), SPEED), FRAGMENT, ORDER)
    return kept.select(*FRAGMENT, "l_orderkey", "l_linenumber", "l_partkey")


@query("drop_fragments", """
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM lineitem WHERE l_discount > 0)
WHERE n >= 190
""")
def drop_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sequences.drop_fragments(drop_silence(_process(spark, sf_dir), SPEED), FRAGMENT, 190)
    return kept.select(*FRAGMENT, "l_orderkey", "l_linenumber", "l_partkey")


def _windows_sql(partition: str, size: int, stride: int = 1, key: str = "user_id, ") -> str:
    frame = f"{partition} ORDER BY ts, event_id ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW"
    return f"""
WITH {SIGNALS_SQL},
framed AS (SELECT {key}us, row_number() OVER ({partition} ORDER BY ts, event_id) AS r,
                  first_value(us) OVER ({frame}) AS start_us, first_value(value) OVER ({frame}) AS first_value,
                  avg(value) OVER ({frame}) AS mean, list(k) OVER ({frame}) AS ks
           FROM signals)
SELECT {key}r - {size} AS window_id, CAST(start_us AS BIGINT) AS start_us, CAST(us AS BIGINT) AS end_us,
       len(ks) AS steps, first_value, ks[{size // 2}] AS middle_k, round(mean, 4) AS mean
FROM framed WHERE r >= {size} AND (r - {size}) % {stride} = 0"""


def _summary(found: DataFrame, size: int, keys: list[str]) -> DataFrame:
    total = F.aggregate("steps", F.lit(0.0), lambda t, x: t + x["value"])
    return found.select(
        *keys, "window_id", F.unix_micros("start_ts").alias("start_us"),
        F.unix_micros("end_ts").alias("end_us"), F.size("steps").cast("bigint").alias("steps"),
        F.element_at("steps", 1)["value"].alias("first_value"),
        F.element_at("steps", size // 2)["k"].alias("middle_k"),
        F.round(total / size, 4).alias("mean"))


@query("sliding_windows", _windows_sql("PARTITION BY user_id", 10))
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.sliding_windows(signals(spark, sf_dir), USER, SIGNAL_ORDER, SENSORS, 10)
    return _summary(found, 10, USER)


@query("sliding_windows_stride", _windows_sql("PARTITION BY user_id", 60, 5))
def sliding_windows_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.sliding_windows(signals(spark, sf_dir), USER, SIGNAL_ORDER, SENSORS, 60, 5)
    return _summary(found, 60, USER)


@query("sliding_windows_global", _windows_sql("", 10, key=""))
def sliding_windows_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.sliding_windows(signals(spark, sf_dir), [], SIGNAL_ORDER, SENSORS, 10)
    return _summary(found, 10, [])


@query("freeze_flag", f"""
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey,
       CASE WHEN count(*) OVER w >= 3
            THEN stddev_pop(l_discount) OVER w < 1e-4 OR stddev_pop(l_tax) OVER w < 1e-4 END AS is_freeze
FROM lineitem
WINDOW w AS (PARTITION BY l_suppkey, l_returnflag ORDER BY {ORDER_SQL}
             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def freeze_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = windows.freeze_flag(_process(spark, sf_dir), FRAGMENT, ORDER, [SPEED, THICKNESS], 3)
    return flagged.select(*FRAGMENT, "l_orderkey", "l_linenumber", "l_partkey", "is_freeze")


@query("rolling_history", f"""
WITH {SIGNALS_SQL}
SELECT event_id, count(*) OVER w AS n, first_value(value) OVER w AS oldest, max(k) OVER w AS top_k,
       round(avg(value) OVER w, 9) AS mean
FROM signals
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
""")
def rolling_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = windows.rolling_history(signals(spark, sf_dir), USER, SIGNAL_ORDER, SENSORS, 100)
    total = F.aggregate("value_history", F.lit(0.0), lambda t, x: t + x)
    return history.select(
        "event_id", F.size("value_history").cast("bigint").alias("n"),
        F.element_at("value_history", 1).alias("oldest"), F.array_max("k_history").alias("top_k"),
        F.round(total / F.size("value_history"), 9).alias("mean"))


PADDED_SQL = f"""
WITH {SIGNALS_SQL},
framed AS (SELECT event_id, list(value) OVER w AS l FROM signals
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))
SELECT event_id, CAST(60 AS BIGINT) AS steps, l[1] AS first_value, l[len(l)] AS last_value,
       round((list_sum(l) + (60 - len(l)) * l[1]) / 60, 4) AS mean
FROM framed"""


@query("padded_window", PADDED_SQL)
def padded_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = windows.padded_windows(signals(spark, sf_dir), USER, SIGNAL_ORDER, ["value"], 60)
    total = F.aggregate("steps", F.lit(0.0), lambda t, x: t + x["value"])
    return padded.select(
        "event_id", F.size("steps").cast("bigint").alias("steps"),
        F.element_at("steps", 1)["value"].alias("first_value"),
        F.element_at("steps", -1)["value"].alias("last_value"), F.round(total / 60, 4).alias("mean"))


@query("chrono_split", f"""
WITH {SIGNALS_SQL},
numbered AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM signals)
SELECT event_id, CASE WHEN r <= CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) THEN 'train'
                      WHEN r <= CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'val'
                      ELSE 'test' END AS split FROM numbered
""")
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir).select("event_id", "ts")
    return sequences.chronological_split(rows, SIGNAL_ORDER).select("event_id", "split")


@query("tail_rows", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC LIMIT 50000
""")
def tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = sequences.tail_rows(_process(spark, sf_dir), [*ORDER, "l_suppkey"], 50_000)
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", EJECTION)


@query("sample_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 10000
""")
def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_n(rows, 10_000, ["o_orderkey"], 42)
