"""Order-based operators over series: gaps, warm-up, fragments, splits in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.signals import (
    as_timestamp, epoch_seconds, seconds_between, typed_literal,
)
from millrace.operators.ordered import (
    CHUNK, POSITION, ROWS_PER_TASK, cut, positions, previous, running_sum,
)
from millrace.operators.sizes import broadcast_if_small

# Up to this many rows a plain ordered limit is merged cheaply in one task.
SMALL_LIMIT = 10_000


def split_sequences_by_gap(df: DataFrame, time_col: str, gap_seconds: int = 600,
                           tie_break: Sequence[str] = (), by: Sequence[str] = (),
                           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``sequence_id``: 1, 2, ... counting up wherever more than ``gap_seconds`` pass.

    Both times are rounded down to seconds first, so a step of 600.9 s can still
    belong to the same sequence. Rows with equal times share an id. Rows without
    a time come first: k of them all get id k, and the first timed row gets k + 1.
    ``tie_break`` columns let rows with one and the same time be spread over tasks.
    """
    columns = df.columns
    rows = df.withColumn("__ts", as_timestamp(F.col(time_col), df.schema[time_col].dataType))
    timed = rows.filter(F.col("__ts").isNotNull())
    chunks = cut(timed, by, ["__ts", *tie_break], rows_per_task)
    step = previous(chunks, chunks.df, "__ts", "__before")
    gap = epoch_seconds(F.col("__ts")) - epoch_seconds(F.col("__before"))
    flagged = step.withColumn("__new", F.when(gap <= gap_seconds, 0).otherwise(1))
    numbered = (running_sum(chunks, flagged, F.col("__new"), "sequence_id")
                .select(*columns, F.col("sequence_id").cast("bigint").alias("sequence_id")))
    untimed = rows.filter(F.col("__ts").isNull()).select(*columns)
    if untimed.isEmpty():
        return numbered

    if not by:
        k = F.lit(untimed.count()).cast("bigint")
        return (numbered.withColumn("sequence_id", F.col("sequence_id") + k)
                .unionByName(untimed.withColumn("sequence_id", k)))
    first = untimed.groupBy(*by).agg(F.count(F.lit(1)).alias("__k"))
    keyed = first.select(*[F.col(c).alias(f"__by_{c}") for c in by], "__k")

    def with_k(side: DataFrame) -> DataFrame:
        same = [side[c].eqNullSafe(keyed[f"__by_{c}"]) for c in by]
        return side.join(keyed, same, "left").drop(*[f"__by_{c}" for c in by])

    base = F.coalesce(F.col("__k"), F.lit(0))
    return (with_k(numbered).withColumn("sequence_id", F.col("sequence_id") + base).drop("__k")
            .unionByName(with_k(untimed).withColumn("sequence_id", base).drop("__k")))


def gap_profile(df: DataFrame, time_col: str, tie_break: Sequence[str] = (),
                by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``by`` columns, ``time_col`` and ``gap_seconds`` to the row before; first rows are left out."""
    rows = df.select(*dict.fromkeys([*by, *tie_break]),
                     as_timestamp(F.col(time_col), df.schema[time_col].dataType).alias(time_col))
    rows = rows.filter(F.col(time_col).isNotNull())
    chunks = cut(rows, by, [time_col, *tie_break], rows_per_task)
    step = previous(chunks, chunks.df, time_col, "__before")
    return (step.filter(F.col("__before").isNotNull())
            .withColumn("gap_seconds", seconds_between(F.col(time_col), F.col("__before")))
            .drop("__before", CHUNK))


def trim_warmup(df: DataFrame, fragment: Sequence[str], order_by: Sequence[str],
                warmup_rows: int = 90, min_rows: int = 0,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Drop the first ``warmup_rows`` rows of every fragment, then fragments that are too short.

    A fragment needs ``min_rows`` rows after the warm-up to stay. Both rules share
    one shuffle and one sort. A fragment that is cut in chunks has more rows than
    both rules ask for, so it always stays.
    """
    chunks = cut(df, fragment, order_by, max(rows_per_task, warmup_rows + min_rows))
    kept = positions(chunks, chunks.df).filter(F.col(POSITION) > warmup_rows)
    if min_rows:
        left = F.count(F.lit(1)).over(Window.partitionBy(*fragment, CHUNK))
        kept = (kept.withColumn("__left", left)
                .filter(chunks.hot | (F.col("__left") >= min_rows)).drop("__left"))
    return kept.drop(CHUNK, POSITION)


def drop_fragments(df: DataFrame, fragment: Sequence[str], min_rows: int = 100) -> DataFrame:
    """Drop fragments with fewer than ``min_rows`` rows.

    The count is combined on the map side and joined back, so a fragment of any
    size never meets in one task.
    """
    sizes = df.groupBy(*fragment).agg(F.count(F.lit(1)).alias("__n"))
    keep = broadcast_if_small(sizes.filter(F.col("__n") >= min_rows).select(
        *[F.col(c).alias(f"__by_{c}") for c in fragment]))
    same = [df[c].eqNullSafe(keep[f"__by_{c}"]) for c in fragment]
    return df.join(keep, same, "left_semi")


def keys_at_ranks(df: DataFrame, order_by: Sequence[str], ranks: Sequence[int],
                  rows_per_task: int = ROWS_PER_TASK, total: int | None = None) -> dict[int, tuple]:
    """Order keys at the given 1-based ranks of the whole table.

    Counts per chunk locate each rank; only the chunks that hold one are sorted.
    """
    keys = df.select(*order_by)
    total = df.count() if total is None else total
    chunks = cut(keys, (), order_by, rows_per_task, total)
    counts = [(0, total)]
    if chunks.split:
        counts = (chunks.df.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("n"))
                  .orderBy(CHUNK).collect())
    wanted, before = [], 0
    for chunk, n in counts:
        wanted += [(chunk, rank - before, rank) for rank in ranks if before < rank <= before + n]
        before += n
    if not wanted:
        return {}
    local = (chunks.df.filter(F.col(CHUNK).isin(sorted({c for c, _, _ in wanted})))
             .withColumn("__r", F.row_number().over(chunks.window)))
    hit = F.lit(False)
    for chunk, r, _ in wanted:
        hit = hit | ((F.col(CHUNK) == chunk) & (F.col("__r") == r))
    found = {(row[CHUNK], row["__r"]): tuple(row[c] for c in order_by)
             for row in local.filter(hit).collect()}
    return {rank: found[chunk, r] for chunk, r, rank in wanted}


def _key_literal(df: DataFrame, order_by: Sequence[str], key: tuple) -> Column:
    types = {f.name: f.dataType for f in df.schema}
    return F.struct(*[typed_literal(v, types[c]).alias(c) for v, c in zip(key, order_by)])


def chronological_split(df: DataFrame, order_by: Sequence[str], train: float = 0.70,
                        validation: float = 0.85, name: str = "split",
                        rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Label rows train, val or test in time order, cut at ``int(n * share)`` rows.

    The two cut keys are found first; the labelling itself is then a projection
    that moves no data. If a cut falls between rows with equal order keys, rows
    are numbered instead, so the sizes are exact in every case.
    """
    n = df.count()
    ends = [int(n * train), int(n * validation)]
    at = keys_at_ranks(df, order_by, sorted({r for e in ends for r in (e, e + 1) if 1 <= r <= n}),
                       rows_per_task, n)
    if any(1 <= e < n and at[e] == at[e + 1] for e in ends):
        chunks = cut(df, (), order_by, rows_per_task, n)
        numbered = positions(chunks, chunks.df)
        tests = [F.col(POSITION) <= e for e in ends]
    else:
        numbered = df
        key = F.struct(*[F.col(c) for c in order_by])
        tests = [F.lit(False) if e < 1 else key <= _key_literal(df, order_by, at[e]) for e in ends]
    label = F.when(tests[0], "train").when(tests[1], "val").otherwise("test")
    return numbered.withColumn(name, label).drop(CHUNK, POSITION)


def tail_rows(df: DataFrame, order_by: Sequence[str], n: int = 50_000,
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The last ``n`` rows in order."""
    if n <= SMALL_LIMIT:
        return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n)
    total = df.count()
    if total <= n:
        return df
    start = total - n
    at = keys_at_ranks(df, order_by, [start, start + 1], rows_per_task, total)
    if at[start] != at[start + 1]:
        key = F.struct(*[F.col(c) for c in order_by])
        return df.filter(key >= _key_literal(df, order_by, at[start + 1]))
    chunks = cut(df, (), order_by, rows_per_task, total)
    return positions(chunks, chunks.df).filter(F.col(POSITION) > start).drop(CHUNK, POSITION)
