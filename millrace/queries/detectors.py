"""Scaling, detectors, scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import scaling, sequences
from millrace.operators.detect import consensus, iforest, pca, window_model
from millrace.operators.sizes import spread_if_small
from millrace.queries.profiles import SPLIT_SQL, rounded, scaled_signals
from millrace.queries.registry import (
    EJECTION, FORCE, SIGNAL_ORDER, SIGNALS_SQL, SPEED, THICKNESS, query, signals, table,
)
from millrace.queries.sequences import SENSORS, USER
from millrace.sources.layers import stored

ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
ROW_FEATURES = [EJECTION, FORCE, SPEED, THICKNESS]
WINDOW = 21


@query("minmax_scale", f"""
WITH {SPLIT_SQL}
SELECT event_id, split, value, k FROM scaled
""")
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_signals(spark, sf_dir).select("event_id", "split", "value", "k")


@query("standard_scale", """
WITH s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / d, 6) AS scaled FROM lineitem, s
""")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", EJECTION)
    scaled = scaling.standard_fit(rows, [EJECTION]).apply(rows)
    return rounded(scaled.withColumnRenamed(EJECTION, "scaled"), ["scaled"], 6)


def _row_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-max scaled process rows."""
    rows = table(spark, sf_dir, "lineitem").select(*ROW_KEYS, *ROW_FEATURES)
    return scaling.minmax_fit(rows, ROW_FEATURES).apply(rows)


@query("pca_fit")
def pca_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of variance per component and in total; axes are orthonormal."""
    model = pca.pca_fit(_row_table(spark, sf_dir), ROW_FEATURES, 3)
    gram = model.components @ model.components.T
    rows = [(i, float(r), float(model.explained_ratio.sum()), float(np.abs(gram - np.eye(3)).max()))
            for i, r in enumerate(model.explained_ratio)]
    return spark.createDataFrame(rows, "component int, ratio double, total double, skewness double")


# Eigen-decomposition of a symmetric 2 x 2 covariance matrix [[a, b], [b, c]].
PCA2_SQL = f"""
{SIGNALS_SQL},
m AS (SELECT avg(value) AS mv, avg(k) AS mk, var_samp(value) AS a, covar_samp(value, k) AS b,
             var_samp(k) AS c FROM signals),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1,
             (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM m),
axis AS (SELECT *, (l1 - c) / sqrt((l1 - c) * (l1 - c) + b * b) AS x,
                b / sqrt((l1 - c) * (l1 - c) + b * b) AS y FROM e)"""


@query("pca2_fit", f"""
WITH {PCA2_SQL}
SELECT round(l1 / (l1 + l2), 6) AS ratio_1, round(l2 / (l1 + l2), 6) AS ratio_2,
       round(abs(x), 5) AS axis_value, round(abs(y), 5) AS axis_k FROM axis
""")
def pca2_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pca.pca_fit(signals(spark, sf_dir), SENSORS, 2)
    ratio, axis = model.explained_ratio, np.abs(model.components[0])
    frame = spark.createDataFrame(
        [(float(ratio[0]), float(ratio[1]), float(axis[0]), float(axis[1]))],
        "ratio_1 double, ratio_2 double, axis_value double, axis_k double")
    return rounded(rounded(frame, ["ratio_1", "ratio_2"], 6), ["axis_value", "axis_k"], 5)


@query("pca_error", f"""
WITH {PCA2_SQL},
p AS (SELECT event_id, value - mv AS dv, k - mk AS dk, x, y, x * (value - mv) + y * (k - mk) AS s
      FROM signals, axis)
SELECT event_id, round(((dv - x * s) * (dv - x * s) + (dk - y * s) * (dk - y * s)) / 2, 3) AS error FROM p
""")
def pca_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    model = pca.pca_fit(rows, SENSORS, 1)
    return rows.select("event_id", F.round(model.error(), 3).alias("error"))


@query("iforest_fit")
def iforest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes, leaves and depth of every tree."""
    nodes = iforest.iforest_nodes(_row_table(spark, sf_dir), ROW_FEATURES, ROW_KEYS)
    return nodes.groupBy("tree").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("feature") < 0).alias("leaves"),
        F.max("depth").alias("depth"), F.max("size").alias("sample"))


@query("iforest_score")
def iforest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows flagged by a forest fitted for 5 % outliers, over all rows."""
    rows = _row_table(spark, sf_dir)
    forest = iforest.iforest_fit(rows, ROW_FEATURES, ROW_KEYS)
    narrow = rows.select(*ROW_FEATURES)
    scored = spread_if_small(narrow, narrow.count()).select(forest.score().alias("score"))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score") > 0).alias("flagged"),
                      F.round(F.avg("score"), 6).alias("mean_score"),
                      F.round(F.max("score"), 6).alias("max_score"))


def _fixed_forest() -> iforest.Forest:
    """Two hand-written trees over (l_quantity, l_tax)."""
    import pandas as pd
    columns = ["tree", "node", "feature", "threshold", "depth", "size"]
    nodes = pd.DataFrame([
        (0, 0, 0, 10.0, 0, 8), (0, 1, -1, 0.0, 1, 1), (0, 2, 1, 0.035, 1, 7),
        (0, 5, -1, 0.0, 2, 2), (0, 6, -1, 0.0, 2, 5),
        (1, 0, 1, 0.065, 0, 8), (1, 1, -1, 0.0, 1, 6), (1, 2, -1, 0.0, 1, 2),
    ], columns=columns)
    return iforest.forest_from_nodes(nodes, [EJECTION, THICKNESS], offset=-0.5)


def _path(n: int) -> str:
    return repr(float(iforest.path_length(np.array([n]))[0]))


@query("iforest_score_fixed", f"""
WITH paths AS (
  SELECT *, (CASE WHEN l_quantity <= 10 THEN 1.0e0 WHEN l_tax <= 0.035 THEN 2.0e0 + {_path(2)}
                  ELSE 2.0e0 + {_path(5)} END
           + CASE WHEN l_tax <= 0.065 THEN 1.0e0 + {_path(6)} ELSE 1.0e0 + {_path(2)} END) / 2 AS h
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(pow(2.0e0, -h / {_path(8)}) - 0.5, 8) AS score,
       pow(2.0e0, -h / {_path(8)}) > 0.5 AS outlier FROM paths
""")
def iforest_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                   EJECTION, THICKNESS)
    scored = rows.withColumn("score", _fixed_forest().score())
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", F.round("score", 8).alias("score"),
                         (F.col("score") > 0).alias("outlier"))


def _window_model(rows: DataFrame) -> window_model.WindowModel:
    return window_model.window_model_fit(rows, USER, SIGNAL_ORDER, SENSORS, WINDOW, 3)


@query("window_ae_fit")
def window_ae_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latent axes of the window model: variance share and length of each."""
    model = _window_model(signals(spark, sf_dir))
    share = model.variance / model.variance.sum()
    rows = [(i, float(share[i]), float(np.linalg.norm(a))) for i, a in enumerate(model.axes)]
    return spark.createDataFrame(rows, "latent int, ratio double, length double")


@query("window_error")
def window_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors, latent vector and attribution of every window."""
    rows = signals(spark, sf_dir)
    found = window_model.window_error(rows, USER, SIGNAL_ORDER, _window_model(rows))
    return found.select(
        "user_id", "window_id", F.unix_micros("end_ts").alias("end_us"), "mse", "mae",
        *[F.col("latent")[i].alias(f"z{i}") for i in range(3)],
        *[F.col("attribution")[i].alias(f"error_{c}") for i, c in enumerate(SENSORS)])


MEAN_MODEL_SQL = f"""
{SIGNALS_SQL},
framed AS (SELECT user_id, us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r,
                  var_pop(value) OVER w AS ev, var_pop(k) OVER w AS ek FROM signals
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)),
found AS (SELECT user_id, r - {WINDOW} AS window_id, us, ev, ek FROM framed WHERE r >= {WINDOW})"""


@query("window_error_mean_model", f"""
WITH {MEAN_MODEL_SQL}
SELECT user_id, window_id, CAST(us AS BIGINT) AS end_us, round((ev + ek) / 2, 6) AS mse FROM found
""")
def window_error_mean_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = window_model.window_error(signals(spark, sf_dir), USER, SIGNAL_ORDER,
                                      window_model.MeanModel(tuple(SENSORS), WINDOW))
    return found.select("user_id", "window_id", F.unix_micros("end_ts").alias("end_us"),
                        F.round("mse", 6).alias("mse"))


@query("attribution_rank", f"""
WITH {MEAN_MODEL_SQL},
long AS (SELECT user_id, window_id, 'value' AS sensor, 0 AS i, ev AS error FROM found
         UNION ALL SELECT user_id, window_id, 'k', 1, ek FROM found)
SELECT user_id, window_id, sensor, round(error, 6) AS error,
       row_number() OVER (PARTITION BY user_id, window_id ORDER BY error, i) AS rank FROM long
""")
def attribution_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = window_model.window_error(signals(spark, sf_dir), USER, SIGNAL_ORDER,
                                      window_model.MeanModel(tuple(SENSORS), WINDOW))
    ranked = window_model.rank_attribution(found, ["user_id", "window_id"], SENSORS)
    return rounded(ranked, ["error"], 6)


MAHA_SQL = f"""
{SIGNALS_SQL},
m AS (SELECT avg(value) AS mv, avg(k) AS mk, var_samp(value) AS a, covar_samp(value, k) AS b,
             var_samp(k) AS c FROM signals),
d AS (SELECT event_id, value, ((value - mv) * (c * (value - mv) - b * (k - mk))
                        + (k - mk) * (a * (k - mk) - b * (value - mv))) / (a * c - b * b) AS d2
      FROM signals, m)"""


@query("mahalanobis", f"WITH {MAHA_SQL} SELECT event_id, round(sqrt(d2), 6) AS distance FROM d")
def mahalanobis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    moments = pca.fit_moments(rows, SENSORS)
    return rows.select("event_id", F.round(pca.mahalanobis(moments), 6).alias("distance"))


@query("mahalanobis_alert", f"""
WITH {MAHA_SQL}
SELECT event_id, d2 > {pca.CHI2_P999[2]} AS alert, sqrt(d2) > {pca.CHI2_P999[2]} AS compat_alert FROM d
""")
def mahalanobis_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    distance = pca.mahalanobis(pca.fit_moments(rows, SENSORS))
    return rows.select("event_id", pca.mahalanobis_alert(distance, 2).alias("alert"),
                       pca.mahalanobis_alert(distance, 2, compat=True).alias("compat_alert"))


@query("detect_or", f"""
WITH {MAHA_SQL}
SELECT event_id, d2 > {pca.CHI2_P999[2]} OR value > 300 OR value < 0.05 AS detected FROM d
""")
def detect_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals(spark, sf_dir)
    distance = pca.mahalanobis(pca.fit_moments(rows, SENSORS))
    return rows.select("event_id", consensus.detect_or(
        F.col("value") < 0.05, F.col("value") > 300, pca.mahalanobis_alert(distance, 2)).alias("detected"))


def triple_models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, consensus.TripleDetector]:
    """Raw signals and three detectors, fitted on the scaled training part, that scale by themselves."""
    raw = signals(spark, sf_dir)
    split = stored(sequences.chronological_split(raw, SIGNAL_ORDER), "split", ["split"])
    part = split.filter(F.col("split") == "train")
    scaler = scaling.minmax_fit(part, SENSORS)
    train = scaler.apply(part)
    model = _window_model(train)
    errors = window_model.window_error(train, USER, SIGNAL_ORDER, model)
    thresholds = {**consensus.DEFAULT_THRESHOLDS, "window": consensus.percentile_threshold(errors, "mse")}
    return raw, consensus.TripleDetector(
        tuple(SENSORS), WINDOW, model, pca.pca_fit(train, SENSORS, 1),
        iforest.iforest_fit(train, SENSORS, ["event_id"]), thresholds, scaler)


@query("triple_detector")
def triple_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window model, PCA and forest on every window."""
    rows, detector = triple_models(spark, sf_dir)
    found = consensus.detect(rows, USER, SIGNAL_ORDER, detector)
    return found.select("user_id", "window_id", F.unix_micros("end_ts").alias("end_us"),
                        "window_error", "window_alert", "pca_score", "pca_alert", "iso_score", "iso_alert")


def fixed_window_model(features: list[str], size: int) -> window_model.WindowModel:
    """Axes that keep each sensor's mean over the window: a linear model with a known result."""
    axes = np.kron(np.ones(size), np.eye(len(features))) / np.sqrt(size)
    return window_model.WindowModel(tuple(features), size, np.zeros(size * len(features)), axes,
                                    np.ones(size * len(features)))


def fixed_detector() -> consensus.TripleDetector:
    """Written-down scaler, models and thresholds."""
    import pandas as pd
    nodes = pd.DataFrame([
        (0, 0, 0, 0.1, 0, 8), (0, 1, -1, 0.0, 1, 1), (0, 2, 1, 0.35, 1, 7),
        (0, 5, -1, 0.0, 2, 2), (0, 6, -1, 0.0, 2, 5),
        (1, 0, 1, 0.65, 0, 8), (1, 1, -1, 0.0, 1, 6), (1, 2, -1, 0.0, 1, 2),
    ], columns=["tree", "node", "feature", "threshold", "depth", "size"])
    return consensus.TripleDetector(
        tuple(SENSORS), WINDOW, fixed_window_model(SENSORS, WINDOW),
        pca.Pca(tuple(SENSORS), np.array([0.2, 0.4]), np.array([[0.6, 0.8]]), np.array([1.0, 0.5])),
        iforest.forest_from_nodes(nodes, SENSORS, offset=-0.5),
        {"window": 0.1, "pca": 0.05, "iso": 0.0}, scaling.Scaler(tuple(SENSORS), (10.0, 5.0), (200.0, 50.0)))


# The fixed detector on every full window: CTEs ``signals``, ``events_us`` and ``detected``.
FIXED_DETECTION_SQL = f"""
{SIGNALS_SQL},
events_us AS (SELECT us FROM signals),
scaled AS (SELECT event_id, user_id, ts, us, (value - 10e0) / 200e0 AS v, (k - 5e0) / 50e0 AS q FROM signals),
framed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r,
                  (var_pop(v) OVER w + var_pop(q) OVER w) / 2 AS window_error FROM scaled
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)),
detected AS (
  SELECT event_id, user_id, us, r - {WINDOW} AS window_id, window_error,
         (pow(v - 0.2e0 - 0.6e0 * s, 2) + pow(q - 0.4e0 - 0.8e0 * s, 2)) / 2 AS pca_score,
         pow(2.0e0, -(CASE WHEN v <= 0.1e0 THEN 1.0e0 WHEN q <= 0.35e0 THEN 2.0e0 + {_path(2)}
                           ELSE 2.0e0 + {_path(5)} END
                    + CASE WHEN q <= 0.65e0 THEN 1.0e0 + {_path(6)} ELSE 1.0e0 + {_path(2)} END)
                    / 2 / {_path(8)}) - 0.5e0 AS iso_score
  FROM (SELECT *, 0.6e0 * (v - 0.2e0) + 0.8e0 * (q - 0.4e0) AS s FROM framed WHERE r >= {WINDOW}))"""


@query("triple_detector_fixed", f"""
WITH {FIXED_DETECTION_SQL}
SELECT user_id, window_id, CAST(us AS BIGINT) AS end_us, round(window_error, 5) AS window_error,
       window_error > 0.1 AS window_alert, round(sqrt(pca_score), 6) AS pca_score, pca_score > 0.05 AS pca_alert,
       round(iso_score, 8) AS iso_score, iso_score > 0 AS iso_alert FROM detected
""")
def triple_detector_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written-down detectors on every window of the raw signals."""
    found = consensus.detect(signals(spark, sf_dir), USER, SIGNAL_ORDER, fixed_detector())
    return found.select(
        "user_id", "window_id", F.unix_micros("end_ts").alias("end_us"), F.round("window_error", 5).alias("window_error"),
        "window_alert", F.round(F.sqrt("pca_score"), 6).alias("pca_score"), "pca_alert",
        F.round("iso_score", 8).alias("iso_score"), "iso_alert")


@query("window_error_fixed", f"""
WITH {SIGNALS_SQL},
framed AS (SELECT user_id, us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r,
                  list(value) OVER w AS v, list(k) OVER w AS q FROM signals
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)),
centred AS (SELECT user_id, us, r, v, q, list_avg(v) AS mv, list_avg(q) AS mq FROM framed WHERE r >= {WINDOW}),
spread AS (SELECT *, list_avg(list_transform(v, lambda x: pow(x - mv, 2))) AS ev,
                  list_avg(list_transform(q, lambda x: pow(x - mq, 2))) AS eq,
                  list_avg(list_transform(v, lambda x: abs(x - mv))) AS av,
                  list_avg(list_transform(q, lambda x: abs(x - mq))) AS aq FROM centred)
SELECT user_id, r - {WINDOW} AS window_id, CAST(us AS BIGINT) AS end_us, round((ev + eq) / 2, 5) AS mse,
       round((av + aq) / 2, 5) AS mae, round(mv * sqrt({WINDOW}.0e0), 5) AS z0, round(mq * sqrt({WINDOW}.0e0), 5) AS z1,
       round(ev, 5) AS error_value, round(eq, 5) AS error_k FROM spread
""")
def window_error_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both errors, the latent vector and the attribution of a written-down linear model."""
    found = window_model.window_error(signals(spark, sf_dir), USER, SIGNAL_ORDER, fixed_window_model(SENSORS, WINDOW))
    return rounded(found.select(
        "user_id", "window_id", F.unix_micros("end_ts").alias("end_us"), "mse", "mae",
        F.col("latent")[0].alias("z0"), F.col("latent")[1].alias("z1"),
        *[F.col("attribution")[i].alias(f"error_{c}") for i, c in enumerate(SENSORS)]),
        ["mse", "mae", "z0", "z1", "error_value", "error_k"], 5)


@query("pca_fit_variance", f"""
WITH b AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) - min({c}) AS d_{c}" for c in ROW_FEATURES)} FROM lineitem)
SELECT round({" + ".join(f"var_samp(({c} - lo_{c}) / d_{c})" for c in ROW_FEATURES)}, 7) AS total FROM lineitem, b
""")
def pca_fit_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variances of the fitted components add up to those of the features."""
    model = pca.pca_fit(_row_table(spark, sf_dir), ROW_FEATURES, 3)
    return spark.createDataFrame([(round(float(model.variance.sum()), 7),)], "total double")


@query("window_ae_variance", f"""
WITH {SIGNALS_SQL},
framed AS (SELECT row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, list(value) OVER w AS v,
                  list(k) OVER w AS q FROM signals
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW)),
steps AS (SELECT i, v[i] AS value, q[i] AS k FROM framed, (SELECT unnest(range(1, {WINDOW + 1})) AS i) WHERE r >= {WINDOW}),
spread AS (SELECT var_samp(value) AS a, var_samp(k) AS b FROM steps GROUP BY i)
SELECT round(sum(a + b), 3) AS total FROM spread
""")
def window_ae_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variances of the window model add up to those of the window's places."""
    model = _window_model(signals(spark, sf_dir))
    return spark.createDataFrame([(round(float(model.variance.sum()), 3),)], "total double")


@query("iforest_shape", """
SELECT CAST(t AS INT) AS tree, least(256, (SELECT count(*) FROM lineitem)) AS sample, TRUE AS is_binary,
       TRUE AS within_depth FROM (SELECT unnest(range(0, 100)) AS t)
""")
def iforest_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree is binary, has the whole sample at its root and keeps within its depth."""
    nodes = iforest.iforest_nodes(_row_table(spark, sf_dir), ROW_FEATURES, ROW_KEYS)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.max("size").cast("bigint").alias("sample"), (F.count(F.lit(1)) == 2 * F.count_if(leaf) - 1).alias("is_binary"),
        (F.max("depth") <= 8).alias("within_depth"))


@query("status_kpi", """
SELECT event_id, CASE WHEN value IS NULL THEN 'READY' WHEN value > 100 THEN 'ANOMALY' ELSE 'HEALTHY' END
         AS status,
       greatest(0.0e0, 100.0e0 - (value / 1000) * 1000) AS health,
       CASE WHEN value > 100 THEN 'alert' ELSE 'ok' END AS window_severity,
       CASE WHEN value > 200 THEN 'alert' ELSE 'ok' END AS pca_severity,
       CASE WHEN value < 1 THEN 'warning' ELSE 'ok' END AS iso_severity
FROM events
""")
def status_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    scored = table(spark, sf_dir, "events").select(
        "event_id", (value / 1000).alias("window_error"), (value > 100).alias("window_alert"),
        (value > 200).alias("pca_alert"), (value < 1).alias("iso_alert"))
    return consensus.status_kpi(scored).select("event_id", "status", "health", "window_severity",
                                               "pca_severity", "iso_severity")
