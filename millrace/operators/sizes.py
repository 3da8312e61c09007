"""Joins with a side whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows that may come to the driver and be broadcast from there.
SMALL_ROWS = 100_000
# Rows per core below which a table may not have a partition for every core.
SPREAD_BELOW = 1_000_000


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` for the small side of a join: broadcast if it has at most ``limit`` rows.

    The rows are counted while they are fetched, so a small side is computed once
    and then held as it was. A larger side is returned unchanged: Spark shuffles
    both sides by key and splits skewed keys at run time.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt to all cores if its ``rows`` rows are too few to fill them.

    For work that costs much more per row than moving the row, such as scoring with
    a forest. A large table already has more partitions than there are cores and is
    returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if rows < cores * SPREAD_BELOW else df
