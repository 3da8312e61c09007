"""Exact quantiles (linear interpolation) that do not gather a column in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer. That is used only for groups of at most ``rows_per_task`` rows. Larger
groups are reduced to (value, count), ordered in chunks, and the wanted ranks are
read off the running count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions.signals import nan_to_null
from millrace.operators.ordered import cut, hot_series, rows_of, running_sum
from millrace.operators.sizes import broadcast_if_small
from millrace.session import scratch_path

# Largest group whose distinct values may be kept in one aggregation buffer.
ROWS_PER_BUFFER = 1_000_000


def group_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (),
                    rows_per_task: int = ROWS_PER_BUFFER, name: str = "quantiles") -> DataFrame:
    """One row per group: ``by`` columns, ``n`` values and the array ``name``.

    Missing values (null, NaN) are left out; a group without values gives no row.
    """
    value = nan_to_null(F.col(column), df.schema[column].dataType).cast("double")
    values = df.select(*by, value.alias("__value"))
    # Counting all rows bounds the values from above and does not evaluate ``column``.
    hot = hot_series(df.select(*by), by, rows_per_task)
    small = rows_of(values, by, hot, "left_anti") if hot else values
    # Missing values are left to the aggregates: a filter would evaluate ``column`` again.
    exact = (small.groupBy(*by)
             .agg(F.count("__value").alias("n"),
                  F.percentile("__value", F.array(*[F.lit(float(p)) for p in probs])).alias(name))
             .filter(F.col("n") > 0))
    if not hot:
        return exact
    large = _ranked(rows_of(values, by, hot), probs, by, rows_per_task, name)
    return exact.unionByName(large) if by else large


def _ranked(values: DataFrame, probs: Sequence[float], by: Sequence[str],
            rows_per_task: int, name: str) -> DataFrame:
    # Written out once: it is read for bounds, carries and ranks, and ``column`` may be costly.
    spark = values.sparkSession
    path = scratch_path(spark, "values")
    values.groupBy(*by, "__value").agg(F.count(F.lit(1)).alias("__weight")).write.parquet(path)
    weighted = spark.read.parquet(path).filter(F.col("__value").isNotNull())
    chunks = cut(weighted, by, ["__value"], rows_per_task)
    ranked = running_sum(chunks, chunks.df, F.col("__weight"), "__upto")
    totals = weighted.groupBy(*by).agg(F.sum("__weight").alias("n"))
    if by:  # one row per hot group
        same = [F.col(f"v.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
        joined = ranked.alias("v").join(broadcast_if_small(totals).alias("t"), same).select(
            *[F.col(f"v.{c}").alias(c) for c in by], "__value", "__upto", "n")
    else:
        joined = ranked.withColumn("n", F.lit(totals.first()[0]))

    picks = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("n") - 1)
        picks += [F.min(F.when(F.col("__upto") > F.floor(rank), F.col("__value"))).alias(f"__lo{i}"),
                  F.min(F.when(F.col("__upto") > F.ceil(rank), F.col("__value"))).alias(f"__hi{i}")]
    picked = joined.groupBy(*by).agg(F.max("n").alias("n"), *picks)
    parts = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("n") - 1)
        weight = rank - F.floor(rank)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        parts.append(F.when(lo == hi, lo).otherwise((F.lit(1) - weight) * lo + weight * hi))
    return picked.select(*by, "n", F.array(*parts).alias(name))


def quantiles(df: DataFrame, column: str, probs: Sequence[float],
              rows_per_task: int = ROWS_PER_BUFFER) -> list[float | None]:
    """Quantiles of a whole column as Python numbers (one row reaches the driver)."""
    row = group_quantiles(df, column, probs, (), rows_per_task).select("quantiles").first()
    return list(row[0]) if row else [None] * len(probs)
