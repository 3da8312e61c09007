"""Reproducible sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Up to this size the merge of per-task candidates is cheap without a pre-filter.
SMALL_SAMPLE = 256


def sample_hash(keys: Sequence[str], seed: int | str) -> Column:
    """Hex digest that ranks rows; it depends on the key values and the seed only.

    Any engine with MD5 gives the same digest, hence the same sample.
    """
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys]))


def fast_hash(keys: Sequence[str], seed: int | str) -> Column:
    """The same as a 64-bit number: several times cheaper, but Spark's own."""
    return F.xxhash64(F.lit(str(seed)), *[F.col(c) for c in keys])


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int | str = 42,
             portable: bool = True, total: int | None = None) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer): the smallest digests.

    ``keys`` must identify a row. For a large ``n`` rows are first cut to the
    share of the digest range that should hold them; whether it holds at least
    ``n`` is checked, so the sample is exact. ``portable`` ranks by a digest that
    other engines can repeat. ``total`` is the row count, if it is known.
    """
    ranked = df.withColumn("__rank", (sample_hash if portable else fast_hash)(keys, seed))
    if n > SMALL_SAMPLE:
        total = df.count() if total is None else total
        share = min(1.0, (n + 10 * n ** 0.5 + 100) / max(total, 1))
        if share < 0.5:
            below = (F.lit(format(int(share * 16 ** 8), "08x")) if portable
                     else F.lit(int(share * 2 ** 64) - 2 ** 63))
            candidates = ranked.filter(F.col("__rank") < below)
            if candidates.count() >= n:
                ranked = candidates
    return ranked.orderBy("__rank", *keys).limit(n).drop("__rank")
