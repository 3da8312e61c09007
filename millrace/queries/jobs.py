"""The layered job and the model store, end to end on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.features import PRODUCT_DIAMETERS, TENSOR_FEATURES
from millrace.operators.profile import leakage_check
from millrace.plans.layers import gold_job, silver_job
from millrace.plans.models import load_detector, save_detector, score_table
from millrace.queries.cleaning import DIAMETERS_SQL
from millrace.queries.detectors import FIXED_DETECTION_SQL, fixed_detector, triple_models
from millrace.queries.profiles import rounded
from millrace.queries.registry import ORDER_SQL, SIGNAL_ORDER, query, signals, table
from millrace.queries.sequences import SENSORS, USER
from millrace.session import scratch_path

TIES = ["order_key", "line", "part_key", "supplier"]
FEATURE_SQL = {"dynamic_tensile_strength": "(l_extendedprice * 2 * 1000) / (pi() * diameter * l_tax)",
               "ejection": "l_quantity", "tbl_speed": "l_discount", "cyl_main": "l_tax",
               "tbl_fill": "p_retailprice"}


def _gold_sql() -> str:
    names = list(FEATURE_SQL)
    made = ", ".join(f"{sql} AS {name}" for name, sql in FEATURE_SQL.items())
    bounds = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in names)
    scaled = ", ".join(f"({c} - lo_{c}) / (hi_{c} - lo_{c}) AS {c}" for c in names)
    means = ", ".join(f"round(avg({c}), 7) AS {c}" for c in names)
    return f"""
WITH dim(code, diameter) AS (VALUES {DIAMETERS_SQL}),
active AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY {ORDER_SQL}) AS r
  FROM lineitem WHERE l_discount > 0),
warm AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM active WHERE r > 90),
silver AS (SELECT w.*, p.p_retailprice, CAST(d.diameter AS DOUBLE) AS diameter
           FROM warm w LEFT JOIN part p ON w.l_partkey = p.p_partkey
                LEFT JOIN dim d ON CAST(p.p_size AS VARCHAR) = d.code WHERE n >= 100),
gold AS (SELECT row_number() OVER (ORDER BY {ORDER_SQL}, l_suppkey) AS r, count(*) OVER () AS n, {made}
         FROM silver WHERE l_tax > 0),
split AS (SELECT *, CASE WHEN r <= CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) THEN 'train'
                         WHEN r <= CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'val'
                         ELSE 'test' END AS split FROM gold),
bounds AS (SELECT {bounds} FROM split WHERE split = 'train'),
scaled AS (SELECT split, {scaled} FROM split, bounds)
SELECT split, count(*) AS rows, round(greatest({", ".join(f"max({c})" for c in names)}), 6) AS max_value,
       {means} FROM scaled GROUP BY split"""


@query("layered_etl", _gold_sql())
def layered_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text files to the cleaned table to the scaled splits, each written and read back."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    raw = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.concat_ws("-", "l_suppkey", "l_returnflag").alias("Batch"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("Log Time"),
        F.col("l_discount").alias("tbl_speed"), F.col("l_extendedprice").alias("main_comp"),
        F.col("l_quantity").alias("ejection"), F.col("l_tax").alias("cyl_main"),
        F.col("p_retailprice").alias("tbl_fill"), F.col("p_size").cast("double").alias("Product Code"),
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supplier"))
    bronze, clean, final = (scratch_path(spark, n) for n in ("bronze", "silver", "gold"))
    raw.write.option("sep", ";").option("header", "true").csv(bronze)
    dimension = spark.createDataFrame(list(PRODUCT_DIAMETERS.items()),
                                      "product_code string, diameter double")
    silver_job(spark, bronze, clean, dimension, ["batch"],
               ["tbl_speed", "main_comp", "ejection", "cyl_main", "tbl_fill", *TIES], TIES[:3])
    made = gold_job(spark, clean, final, order_by=["timestamp", *TIES])
    checked = leakage_check(made.rows, TENSOR_FEATURES)
    means = made.rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                           *[F.avg(c).alias(c) for c in TENSOR_FEATURES])
    return rounded(rounded(means.join(checked, "split"), TENSOR_FEATURES, 7), ["max_value"], 6)


@query("model_store")
def model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detectors fitted, written, read back and applied to every window."""
    rows, detector = triple_models(spark, sf_dir)
    path = scratch_path(spark, "models")
    save_detector(spark, path, detector)
    scored = score_table(rows, USER, SIGNAL_ORDER, load_detector(spark, path, SENSORS))
    return scored.groupBy("status", "pca_severity", "iso_severity").agg(
        F.count(F.lit(1)).alias("windows"), F.round(F.min("health"), 4).alias("min_health"))


@query("model_store_fixed", f"""
WITH {FIXED_DETECTION_SQL}
SELECT CASE WHEN window_error > 0.1 THEN 'ANOMALY' ELSE 'HEALTHY' END AS status,
       CASE WHEN pca_score > 0.05 THEN 'alert' ELSE 'ok' END AS pca_severity,
       CASE WHEN iso_score > 0 THEN 'warning' ELSE 'ok' END AS iso_severity,
       count(*) AS windows, round(min(greatest(0.0e0, 100.0e0 - window_error * 1000)), 4) AS min_health
FROM detected GROUP BY ALL
""")
def model_store_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written-down detectors and their scaler, stored, read back and applied to raw rows."""
    path = scratch_path(spark, "models")
    save_detector(spark, path, fixed_detector())
    scored = score_table(signals(spark, sf_dir), USER, SIGNAL_ORDER, load_detector(spark, path, SENSORS))
    return scored.groupBy("status", "pca_severity", "iso_severity").agg(
        F.count(F.lit(1)).alias("windows"), F.round(F.min("health"), 4).alias("min_health"))
