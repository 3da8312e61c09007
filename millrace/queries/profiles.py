"""Aggregations, profiles and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import cleaning, features, profile
from millrace.operators.detect.consensus import percentile_threshold
from millrace.operators.detect.pca import moments_frame
from millrace.operators.quantiles import group_quantiles
from millrace.operators.scaling import minmax_fit
from millrace.operators.sequences import chronological_split, gap_profile, trim_warmup
from millrace.queries.registry import (
    EJECTION, FORCE, FRAGMENT, ORDER, SIGNAL_ORDER, SIGNALS_SQL, SPEED, THICKNESS,
    query, signals, table,
)
from millrace.queries.cleaning import PURGED_SQL


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("recover_diameter", """
WITH lab AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS code, p_retailprice AS f,
         CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE CAST(p_size - 1 AS DOUBLE) END AS s,
         CAST(p_size AS DOUBLE) AS t FROM part)
SELECT CAST(CAST(code AS BIGINT) AS VARCHAR) AS product_code,
       round(avg((f * 2) / (pi() * s * t)), 2) AS diameter
FROM lab WHERE s > 0 AND t > 0 GROUP BY code
""")
def recover_diameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laboratory rows as text, with unreadable and zero strengths."""
    lab = table(spark, sf_dir, "part").select(
        F.concat(F.regexp_replace("p_brand", "Brand#", ""), F.lit(".0")).alias("code"),
        F.col("p_retailprice").cast("string").alias("tbl_av_hardness"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("n/a"))
        .otherwise((F.col("p_size") - 1).cast("string")).alias("tbl_tensile"),
        F.col("p_size").cast("string").alias("tbl_max_thickness"))
    return features.recover_diameters(lab)


RESULTS_SQL = """
results AS (SELECT l_returnflag AS model, l_linestatus AS type, l_discount AS magnitude,
                   l_tax > 0.04 AS detected, l_quantity AS snr, l_tax AS mae_anomaly FROM lineitem)"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("type"),
        F.col("l_discount").alias("magnitude"), (F.col("l_tax") > 0.04).alias("detected"),
        F.col("l_quantity").alias("snr"), F.col("l_tax").alias("mae_anomaly"))


@query("detection_rate", f"""
WITH {RESULTS_SQL}
SELECT model, type, magnitude, count(*) AS trials,
       round(avg(CAST(detected AS DOUBLE)) * 100, 9) AS detection_rate
FROM results GROUP BY model, type, magnitude
""")
def detection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.detection_rate(_results(spark, sf_dir)), ["detection_rate"], 9)


@query("stress_summary", f"""
WITH {RESULTS_SQL}
SELECT type, magnitude, CASE WHEN grouping(magnitude) = 1 THEN 'type' ELSE 'type_magnitude' END AS level,
       round(avg(CAST(detected AS DOUBLE)) * 100, 9) AS detection_rate, round(avg(snr), 9) AS avg_snr,
       round(avg(mae_anomaly), 9) AS avg_anomaly_mae
FROM results GROUP BY GROUPING SETS ((type, magnitude), (type))
""")
def stress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.stress_summary(_results(spark, sf_dir))
    return rounded(summary, ["detection_rate", "avg_snr", "avg_anomaly_mae"], 9)


@query("silence_profile", """
SELECT count(*) AS rows, count(*) FILTER (l_discount = 0) AS zero_rows,
       round(count(*) FILTER (l_discount = 0) * 100.0 / count(*), 6) AS zero_pct FROM lineitem
""")
def silence_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.silence_profile(table(spark, sf_dir, "lineitem"), SPEED), ["zero_pct"], 6)


@query("describe", """
SELECT l_returnflag, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag
""")
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.describe(table(spark, sf_dir, "lineitem"), FORCE, ["l_returnflag"])
    return rounded(stats, ["mean", "std", "q25", "q50", "q75"])


@query("distinct_sources", "SELECT count(DISTINCT user_id) AS n_distinct FROM events")
def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_count(table(spark, sf_dir, "events"), "user_id")


@query("largest_batch", """
SELECT l_suppkey, l_returnflag, count(*) AS rows FROM lineitem GROUP BY ALL
ORDER BY rows DESC, l_suppkey, l_returnflag LIMIT 1
""")
def largest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.largest_group(table(spark, sf_dir, "lineitem"), FRAGMENT)


@query("threshold_p999", """
SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.999), 6) AS threshold,
       (SELECT round(quantile_cont(value, 0.999), 6) FROM events) AS overall
FROM events GROUP BY event_type
""")
def threshold_p999(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    overall = percentile_threshold(rows, "value", 99.9)
    groups = group_quantiles(rows, "value", [0.999], ["event_type"])
    return groups.select("event_type", "n", F.round(F.col("quantiles")[0], 6).alias("threshold"),
                         F.round(F.lit(overall), 6).alias("overall"))


SPLIT_SQL = f"""
{SIGNALS_SQL},
numbered AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM signals),
split AS (SELECT *, CASE WHEN r <= CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) THEN 'train'
                         WHEN r <= CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'val'
                         ELSE 'test' END AS split FROM numbered),
bounds AS (SELECT min(value) AS v0, max(value) AS v1, min(k) AS k0, max(k) AS k1
           FROM split WHERE split = 'train'),
scaled AS (SELECT s.* EXCLUDE (value, k), (value - v0) / (v1 - v0) AS value, (k - k0) / (k1 - k0) AS k
           FROM split s, bounds)"""


def scaled_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals split in time order and min-max scaled with the range of the training rows."""
    split = chronological_split(signals(spark, sf_dir), SIGNAL_ORDER)
    return minmax_fit(split.filter(F.col("split") == "train"), ["value", "k"]).apply(split)


@query("leakage_check", f"""
WITH {SPLIT_SQL}
SELECT split, round(greatest(max(value), max(k)), 6) AS max_value FROM scaled GROUP BY split
""")
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.leakage_check(scaled_signals(spark, sf_dir), ["value", "k"]), ["max_value"], 6)


@query("split_counts", f"WITH {SPLIT_SQL} SELECT split, count(*) AS n FROM split GROUP BY split")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(signals(spark, sf_dir), SIGNAL_ORDER)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("purge_report", f"""
WITH {PURGED_SQL},
raw AS (SELECT l_suppkey, l_returnflag, count(*) AS b FROM lineitem GROUP BY ALL),
kept AS (SELECT l_suppkey, l_returnflag, count(*) AS a FROM silver GROUP BY ALL),
sizes AS (SELECT b, coalesce(a, 0) AS a FROM raw LEFT JOIN kept USING (l_suppkey, l_returnflag))
SELECT count(*) FILTER (a > 0) AS fragments_kept, count(*) AS fragments,
       CAST(sum(a) AS BIGINT) AS rows_retained, CAST(sum(b - a) AS BIGINT) AS rows_dropped,
       round(sum(b - a) * 100.0 / (sum(a) + sum(b - a)), 5) AS drop_pct
FROM sizes
""")
def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(*FRAGMENT, *ORDER, SPEED)
    kept = trim_warmup(cleaning.drop_silence(raw, SPEED), FRAGMENT, ORDER, 90, 100)
    return rounded(profile.purge_report(raw, kept, FRAGMENT), ["drop_pct"], 5)


@query("histogram", f"""
WITH {SIGNALS_SQL},
gaps AS (SELECT (us - lag(us) OVER (ORDER BY ts, event_id)) / 1000000.0 AS g FROM signals),
near AS (SELECT g FROM gaps WHERE g < 60),
edges AS (SELECT min(g) AS lo, max(g) AS hi FROM near),
binned AS (SELECT CAST(least(floor((g - lo) / (hi - lo) * 60), 59) AS BIGINT) AS bin, count(*) AS n
           FROM near, edges GROUP BY 1)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 60), 6) AS lower,
       round(lo + (b.bin + 1) * ((hi - lo) / 60), 6) AS upper, coalesce(n, 0) AS n
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(60)) b LEFT JOIN binned USING (bin), edges
""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time gaps below a minute in 60 bins."""
    gaps = gap_profile(signals(spark, sf_dir), "ts", ["event_id"])
    bins = profile.histogram(gaps, "gap_seconds", 60, F.col("gap_seconds") < 60)
    return rounded(bins, ["lower", "upper"], 6)


@query("box_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
                  quantile_cont(value, 0.75) AS q75 FROM events GROUP BY event_type)
SELECT event_type, round(max(q25), 4) AS q25, round(max(q50), 4) AS q50, round(max(q75), 4) AS q75,
       min(value) FILTER (value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_low,
       max(value) FILTER (value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_high,
       count(*) FILTER (NOT value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS outliers
FROM events JOIN q USING (event_type) GROUP BY event_type
""")
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.box_stats(table(spark, sf_dir, "events"), "value", ["event_type"])
    return rounded(stats, ["q25", "q50", "q75"])


@query("speed_force_corr", """
SELECT round(corr(l_extendedprice, l_quantity), 6) AS corr,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, count(*) AS rows FROM lineitem
""")
def speed_force_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = profile.rate_dependence(table(spark, sf_dir, "lineitem"), EJECTION, FORCE)
    return rounded(rounded(result, ["corr"], 6), ["slope"])


@query("cov_matrix", """
SELECT count(*) AS n, round(avg(l_quantity), 6) AS mean_l_quantity,
       round(avg(l_discount), 8) AS mean_l_discount, round(avg(l_tax), 8) AS mean_l_tax,
       round(var_samp(l_quantity), 5) AS cov_l_quantity_l_quantity,
       round(covar_samp(l_quantity, l_discount), 7) AS cov_l_quantity_l_discount,
       round(covar_samp(l_quantity, l_tax), 7) AS cov_l_quantity_l_tax,
       round(var_samp(l_discount), 9) AS cov_l_discount_l_discount,
       round(covar_samp(l_discount, l_tax), 9) AS cov_l_discount_l_tax,
       round(var_samp(l_tax), 9) AS cov_l_tax_l_tax
FROM lineitem
""")
def cov_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = moments_frame(table(spark, sf_dir, "lineitem"), [EJECTION, SPEED, THICKNESS])
    digits = {"mean_l_quantity": 6, "mean_l_discount": 8, "mean_l_tax": 8,
              "cov_l_quantity_l_quantity": 5, "cov_l_quantity_l_discount": 7,
              "cov_l_quantity_l_tax": 7, "cov_l_discount_l_discount": 9,
              "cov_l_discount_l_tax": 9, "cov_l_tax_l_tax": 9}
    return result.select("n", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("drift_profile", f"""
WITH longest AS (SELECT l_suppkey, l_returnflag FROM lineitem GROUP BY ALL
                 ORDER BY count(*) DESC, l_suppkey, l_returnflag LIMIT 1),
rows AS (SELECT l.*, row_number() OVER (ORDER BY {', '.join(ORDER)}) AS position
         FROM lineitem l JOIN longest USING (l_suppkey, l_returnflag))
SELECT position, round(avg(l_extendedprice) OVER w, 3) AS force_mean,
       round(avg(l_quantity) OVER w, 5) AS ejection_mean,
       (SELECT round(regr_slope(l_extendedprice, position), 5) FROM rows) AS force_slope,
       (SELECT round(regr_slope(l_quantity, position), 8) FROM rows) AS ejection_slope
FROM rows WINDOW w AS (ORDER BY position ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
""")
def drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    slopes, smoothed = profile.drift_profile(
        table(spark, sf_dir, "lineitem").select(*FRAGMENT, *ORDER, FORCE, EJECTION),
        FRAGMENT, ORDER, [FORCE, EJECTION], 30)
    trend = slopes.first()
    return smoothed.select(
        "position", F.round(f"{FORCE}_mean", 3).alias("force_mean"),
        F.round(f"{EJECTION}_mean", 5).alias("ejection_mean"),
        F.round(F.lit(trend[f"{FORCE}_slope"]), 5).alias("force_slope"),
        F.round(F.lit(trend[f"{EJECTION}_slope"]), 8).alias("ejection_slope"))
