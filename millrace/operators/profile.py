"""Profiles and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.signals import nan_to_null, typed_literal
from millrace.operators.ordered import ROWS_PER_TASK
from millrace.operators.quantiles import ROWS_PER_BUFFER, group_quantiles
from millrace.operators.sizes import broadcast_if_small
from millrace.operators.windows import rolling_mean


def silence_profile(df: DataFrame, speed: str) -> DataFrame:
    """Rows at zero speed: count and share in percent."""
    zero = F.col(speed) == 0
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(zero).alias("zero_rows"),
                  (F.count_if(zero) * 100 / F.count(F.lit(1))).alias("zero_pct"))


def describe(df: DataFrame, column: str, by: Sequence[str] = (),
             rows_per_task: int = ROWS_PER_BUFFER) -> DataFrame:
    """count, mean, std (sample), min, exact quartiles and max of the values present."""
    value = nan_to_null(F.col(column), df.schema[column].dataType)
    moments = df.groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    quartiles = group_quantiles(df, column, [0.25, 0.5, 0.75], by, rows_per_task).drop("n")
    joined = _join_groups(moments, quartiles, by)
    q = F.col("quantiles")
    return joined.select(*by, "count", "mean", "std", "min", q[0].alias("q25"),
                         q[1].alias("q50"), q[2].alias("q75"), "max")


def box_stats(df: DataFrame, column: str, by: Sequence[str] = (), whisker: float = 1.5,
              rows_per_task: int = ROWS_PER_BUFFER) -> DataFrame:
    """Quartiles, whiskers (furthest values within ``whisker`` IQR) and outlier count."""
    value = nan_to_null(F.col(column), df.schema[column].dataType)
    rows = df.select(*by, value.cast("double").alias("__value")).filter(F.col("__value").isNotNull())
    quartiles = group_quantiles(df, column, [0.25, 0.5, 0.75], by, rows_per_task)
    q = F.col("quantiles")
    fences = quartiles.select(
        *by, q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"),
        (q[0] - (q[2] - q[0]) * whisker).alias("__low"),
        (q[2] + (q[2] - q[0]) * whisker).alias("__high"))
    joined = _join_groups(rows, fences, by)
    inside = F.col("__value").between(F.col("__low"), F.col("__high"))
    return joined.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in ("q25", "q50", "q75")],
        F.min(F.when(inside, F.col("__value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def _join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-group columns. Without a key there is one group row, put in as literals."""
    if not by:
        row = groups.first()
        if row is None:
            return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in groups.schema})
        return rows.withColumns({
            f.name: typed_literal(row[f.name], f.dataType) for f in groups.schema})
    keyed = broadcast_if_small(groups.withColumnsRenamed({c: f"__by_{c}" for c in by}))
    same = [rows[c].eqNullSafe(keyed[f"__by_{c}"]) for c in by]
    return rows.join(keyed, same, "left").drop(*[f"__by_{c}" for c in by])


def largest_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Key and row count of the largest group; equal sizes go to the smaller key."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), *by).limit(1)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.countDistinct(column)
    return df.agg(count.alias("n_distinct"))


def max_over(features: Sequence[str]) -> Column:
    """Aggregate: the largest value over several columns."""
    parts = [F.max(F.when(~F.isnan(c), F.col(c))) for c in features]
    return parts[0] if len(parts) == 1 else F.greatest(*parts)


def leakage_check(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """Largest scaled value per split: 1 in train, possibly more elsewhere."""
    return df.groupBy(split).agg(max_over(features).alias("max_value"))


def purge_report(raw: DataFrame, kept: DataFrame, fragment: Sequence[str]) -> DataFrame:
    """Fragments kept, rows retained, rows dropped and dropped share over all fragments.

    A fragment that is dropped as a whole counts with all its rows.
    """
    before = raw.groupBy(*fragment).agg(F.count(F.lit(1)).alias("__before"))
    after = kept.groupBy(*fragment).agg(F.count(F.lit(1)).alias("__after"))
    sizes = before.join(after, list(fragment), "left")
    left = F.coalesce(F.col("__after"), F.lit(0))
    return (sizes.agg(F.count_if(left > 0).alias("fragments_kept"),
                      F.count(F.lit(1)).alias("fragments"),
                      F.sum(left).alias("rows_retained"),
                      F.sum(F.col("__before") - left).alias("rows_dropped"))
            .withColumn("drop_pct", F.col("rows_dropped") * 100
                        / (F.col("rows_retained") + F.col("rows_dropped"))))


def histogram(df: DataFrame, column: str, bins: int, where: Column | None = None) -> DataFrame:
    """(bin, lower, upper, n) over min..max of the data; the last bin is closed. Empty bins are 0.

    Only the two edges come to the driver; rows are counted on the map side.
    """
    value = nan_to_null(F.col(column), df.schema[column].dataType).cast("double")
    rows = (df if where is None else df.filter(where)).select(value.alias("__v"))
    rows = rows.filter(F.col("__v").isNotNull())
    lo, hi = rows.agg(F.min("__v"), F.max("__v")).first()
    if lo is None:
        lo = hi = 0.0
    if lo == hi:  # one value: a bin range of width 1 around it
        lo, hi = lo - 0.5, hi + 0.5
    bin_of = F.least(F.floor((F.col("__v") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("bigint")
    counts = rows.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    edges = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (edges.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * width).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def rate_dependence(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation and least-squares slope of ``y`` on ``x``."""
    return df.agg(F.corr(x, y).alias("corr"), F.regr_slope(y, x).alias("slope"),
                  F.count(F.lit(1)).alias("rows"))


def drift_profile(df: DataFrame, batch: Sequence[str], order_by: Sequence[str],
                  features: Sequence[str], smooth: int = 30,
                  rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Trend over time in the longest batch: (slope per feature, smoothed series).

    The slope is per row of the batch. The longest batch is found first; its key
    is one literal filter.
    """
    row = largest_group(df, batch).first()
    types = {f.name: f.dataType for f in df.schema}
    same = F.lit(True)
    for c in batch:
        same = same & F.col(c).eqNullSafe(typed_literal(row[c], types[c]))
    longest = df.filter(same)
    smoothed = rolling_mean(longest, (), order_by, features, smooth, rows_per_task)
    slopes = smoothed.agg(F.count(F.lit(1)).alias("rows"), *[
        F.regr_slope(F.col(c), F.col("position")).alias(f"{c}_slope") for c in features])
    return slopes, smoothed


def detection_rate(results: DataFrame, by: Sequence[str] = ("model", "type", "magnitude")) -> DataFrame:
    """Share of detected trials in percent."""
    rate = F.avg(F.col("detected").cast("double")) * 100
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("trials"), rate.alias("detection_rate"))


def stress_summary(results: DataFrame) -> DataFrame:
    """Detection rate, SNR and error by (type, magnitude) and by type, in one pass.

    ``level`` tells the two kinds of rows apart; totals by type have no magnitude.
    """
    keys = [F.col("type"), F.col("magnitude")]
    return (results.groupingSets([keys, keys[:1]], *keys)
            .agg(F.grouping("magnitude").alias("__total"),
                 (F.avg(F.col("detected").cast("double")) * 100).alias("detection_rate"),
                 F.avg("snr").alias("avg_snr"),
                 F.avg("mae_anomaly").alias("avg_anomaly_mae"))
            .withColumn("level", F.when(F.col("__total") == 1, "type").otherwise("type_magnitude"))
            .drop("__total"))
