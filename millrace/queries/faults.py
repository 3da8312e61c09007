"""Fault injection and sensitivity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import profile, stress
from millrace.operators.detect import pca, window_model
from millrace.operators.detect.consensus import percentile_threshold
from millrace.operators.ordered import CHUNK, cut, positions
from millrace.operators.windows import sliding_windows
from millrace.queries.detectors import PCA2_SQL, WINDOW
from millrace.queries.profiles import rounded, scaled_signals
from millrace.queries.registry import SIGNAL_ORDER, SIGNALS_SQL, query, signals, table
from millrace.queries.sequences import SENSORS, USER
from millrace.sources.layers import stored

ROW_SCENARIOS = stress.row_scenarios(SENSORS)
WINDOW_SCENARIOS = [("spike", "value", 2.0), ("drift", "k", 3.0), ("freeze", "value", 0.0),
                    ("none", "value", 0.0)]


def _values(scenarios) -> str:
    return ", ".join(f"('{t}', '{f}', CAST({m} AS DOUBLE))" for t, f, m in scenarios)


@query("inject_rows", f"""
WITH {SIGNALS_SQL}, grid(type, feature, magnitude) AS (VALUES {_values(ROW_SCENARIOS)})
SELECT event_id, type, magnitude, CASE WHEN type = 'spike' THEN value + magnitude ELSE value END AS value,
       CASE WHEN type = 'drift_end' THEN k + magnitude ELSE k END AS k
FROM signals, grid
""")
def inject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir).select("event_id", *SENSORS)
    return stress.inject_rows(stress.scenario_grid(rows, ROW_SCENARIOS), SENSORS).drop("feature")


@query("inject_windows", f"""
WITH {SIGNALS_SQL}, grid(type, feature, magnitude) AS (VALUES {_values(WINDOW_SCENARIOS)}),
series AS (SELECT user_id, list(value ORDER BY ts, event_id) AS v, list(k ORDER BY ts, event_id) AS k
           FROM signals GROUP BY user_id),
starts AS (SELECT user_id, window_id, v[window_id + 1:window_id + 10] AS v, k[window_id + 1:window_id + 10] AS k
           FROM series, LATERAL (SELECT unnest(range(0, len(v) - 9)) AS window_id)),
steps AS (SELECT user_id, window_id, step, v[step + 1] AS value, k[step + 1] AS k, v[1] AS v0
          FROM starts, range(10) r(step))
SELECT user_id, window_id, type, step,
       CASE WHEN type = 'spike' AND step BETWEEN 5 AND 9 THEN value + magnitude
            WHEN type = 'freeze' THEN v0 ELSE value END AS value,
       CASE WHEN type = 'drift' THEN k + magnitude * step / 9.0e0 ELSE k END AS k
FROM steps, grid
""")
def inject_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window with every fault, one row per step."""
    found = sliding_windows(signals(spark, sf_dir), USER, SIGNAL_ORDER, SENSORS, 10)
    trials = stress.inject_windows(stress.scenario_grid(found, WINDOW_SCENARIOS), SENSORS, 10)
    return trials.select("user_id", "window_id", "type", F.posexplode("injected").alias("p", "x")).select(
        "user_id", "window_id", "type", F.col("p").cast("bigint").alias("step"), "x.value", "x.k")


def fault_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fault per user, taken from the user's first event."""
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("e"))
    kind = (F.when(F.col("e") % 3 == 0, "spike").when(F.col("e") % 3 == 1, "drift").otherwise("freeze"))
    return first.select("user_id", kind.alias("type"), (F.col("e") % 2).cast("int").alias("sensor"),
                        (F.col("e") % 20).alias("start"))


INJECT_STREAM_SQL = """
first AS (SELECT user_id, min(event_id) AS e FROM events GROUP BY user_id),
plan AS (SELECT user_id, CASE e % 3 WHEN 0 THEN 'spike' WHEN 1 THEN 'drift' ELSE 'freeze' END AS type,
                e % 2 AS sensor, e % 20 AS start FROM first)"""


@query("inject_stream", f"""
WITH {SIGNALS_SQL}, {INJECT_STREAM_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step FROM signals),
planned AS (SELECT n.*, type, sensor, step - start AS elapsed,
                   step >= start AND step - start <= 40 AS active FROM numbered n JOIN plan USING (user_id))
SELECT event_id, step, CASE WHEN active THEN type END AS fault,
       CASE WHEN active AND sensor = 0 THEN
         CASE type WHEN 'spike' THEN value + 0.5e0 WHEN 'drift' THEN value + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE value END AS value,
       CASE WHEN active AND sensor = 1 THEN
         CASE type WHEN 'spike' THEN k + 0.5e0 WHEN 'drift' THEN k + elapsed * 0.02e0 ELSE 0.0e0 END
         ELSE k END AS k
FROM planned
""")
def inject_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled faults by the row's step in its series."""
    chunks = cut(signals(spark, sf_dir), USER, SIGNAL_ORDER)
    rows = positions(chunks, chunks.df, "step").withColumn("step", F.col("step") - 1).drop(CHUNK)
    faulty = stress.inject_stream(rows, fault_schedule(spark, sf_dir), USER, "step", SENSORS)
    return faulty.select("event_id", "step", "fault", *SENSORS)


@query("row_sensitivity_pca", f"""
WITH {PCA2_SQL}, grid(type, feature, magnitude) AS (VALUES {_values(ROW_SCENARIOS)}),
drawn AS (SELECT event_id, value, k FROM signals ORDER BY md5('42:' || event_id), event_id LIMIT 200),
trials AS (SELECT type, magnitude, CASE WHEN type = 'spike' THEN value + magnitude ELSE value END AS v,
                  CASE WHEN type = 'drift_end' THEN k + magnitude ELSE k END AS q FROM drawn, grid),
p AS (SELECT type, magnitude, v - mv AS dv, q - mk AS dk, x, y, x * (v - mv) + y * (q - mk) AS s
      FROM trials, axis),
scored AS (SELECT type, magnitude, ((dv - x * s) * (dv - x * s) + (dk - y * s) * (dk - y * s)) / 2 AS score
           FROM p)
SELECT 'pca' AS model, type, magnitude, count(*) AS trials,
       round(avg(CASE WHEN score > 400 THEN 1.0e0 ELSE 0.0e0 END) * 100, 4) AS detection_rate
FROM scored GROUP BY type, magnitude
""")
def row_sensitivity_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    model = pca.pca_fit(rows, SENSORS, 1)
    trials = stress.row_sensitivity(rows, SENSORS, ["event_id"], {"pca": (model.error(), 400.0)})
    return rounded(profile.detection_rate(trials), ["detection_rate"])


@query("window_sensitivity")
def window_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection rate, SNR and error of the window model per fault."""
    rows = stored(scaled_signals(spark, sf_dir), "scaled", ["split"])
    train, test = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") != "train")
    model = window_model.window_model_fit(train, USER, SIGNAL_ORDER, SENSORS, WINDOW // 2, 3)
    errors = window_model.window_error(train, USER, SIGNAL_ORDER, model)
    limit = percentile_threshold(errors, "mae")
    drawn = stress.sample_windows(test, USER, SIGNAL_ORDER, SENSORS, WINDOW // 2, 100)
    trials = stress.window_sensitivity(
        drawn, USER, model, window_model.latent_moments(errors, 3), limit,
        stress.window_scenarios("value", "k", "k"))
    return rounded(profile.stress_summary(trials), ["detection_rate", "avg_snr", "avg_anomaly_mae"], 6)


