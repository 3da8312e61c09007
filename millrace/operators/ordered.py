"""Ordered operators that stay parallel when one series, or the whole table, is huge.

``Window.partitionBy(series).orderBy(time)`` sends a whole series to one task,
and a window without a key sends the whole table there. The operators here use
that plain window for ordinary series only. A *hot* series (more than
``rows_per_task`` rows) is cut into contiguous chunks of its order key; each
chunk is its own window partition, and what must flow from one chunk to the next
(row counts, running sums, the previous row) comes from a small carry table with
one row per chunk.

The chunk bounds of each hot series are sampled once and written down as a table,
which is joined to the rows. Every branch of a plan, and every task that is run
again, therefore places a row in the same chunk, and the plan has the same size
however many series are hot. Results never depend on where the bounds fall.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, DateType, TimestampNTZType, TimestampType

from millrace.session import scratch_path

CHUNK = "__chunk"
POSITION = "__position"

# Largest series that is handled by one window partition (sorted with spill).
ROWS_PER_TASK = 4_000_000
# Sampled rows per chunk when bounds are chosen, as many as Spark's own range exchange.
SAMPLE_PER_CHUNK = 20
# Tables with a row, or a bound, for each chunk are broadcast up to this many chunks (some
# megabytes) and joined by key beyond.
BROADCAST_CHUNKS = 50_000


@dataclass(frozen=True)
class Hot:
    """Series that are too large for one task: a table of their keys and row counts."""

    keys: DataFrame | None     # ``by`` columns renamed by ``_key_name``, and __n; None: the table
    series: int
    chunks: int                # chunks they will be cut into, about


@dataclass(frozen=True)
class Chunks:
    """How a table is cut: rows of hot series have chunks 1, 2, ..., all others chunk 0."""

    df: DataFrame              # input plus CHUNK
    by: tuple[str, ...]
    order_by: tuple[str, ...]
    chunks: int                # 0: nothing is cut

    @property
    def split(self) -> bool:
        return self.chunks > 0

    @property
    def hot(self) -> Column:
        """True for rows of a hot series, where CHUNK is at hand."""
        return F.col(CHUNK) > 0

    @property
    def window(self):
        return Window.partitionBy(*self.by, CHUNK).orderBy(*self.order_by)


def _key_name(column: str) -> str:
    return f"__key_{column}"


def _same(by: Sequence[str]) -> Column:
    match = F.lit(True)
    for c in by:
        match = match & F.col(f"`{c}`").eqNullSafe(F.col(f"`{_key_name(c)}`"))
    return match


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_CHUNKS else df


def hot_series(df: DataFrame, by: Sequence[str], rows_per_task: int,
               total: int | None = None) -> Hot | None:
    """The series with more than ``rows_per_task`` rows; None if there is none.

    One map-side combined count; two numbers come to the driver. The keys are written
    down, to be joined. ``total``, if known, is the row count of the table; then no series
    of a small table can be hot and nothing is counted.
    """
    if total is not None and total <= rows_per_task:
        return None
    if not by:
        n = df.count() if total is None else total
        return Hot(None, 1, math.ceil(n / rows_per_task)) if n > rows_per_task else None
    counts = (df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows_per_task)
              .withColumnsRenamed({c: _key_name(c) for c in by}))
    facts = counts.agg(F.count(F.lit(1)).alias("series"),
                       F.sum(F.ceil(F.col("__n") / rows_per_task)).alias("chunks")).first()
    if not facts["series"]:
        return None
    path = scratch_path(df.sparkSession, "hot")
    counts.write.parquet(path)
    return Hot(df.sparkSession.read.parquet(path), facts["series"], facts["chunks"])


def rows_of(df: DataFrame, by: Sequence[str], hot: Hot, how: str = "left_semi") -> DataFrame:
    """Rows of the hot series, or with ``left_anti`` all others."""
    if hot.keys is None:
        return df if how == "left_semi" else df.limit(0)
    return df.join(_sized(hot.keys.drop("__n"), hot.series), _same(by), how)


def cut(df: DataFrame, by: Sequence[str], order_by: Sequence[str],
        rows_per_task: int = ROWS_PER_TASK, total: int | None = None) -> Chunks:
    """Add CHUNK so that no ``(series, chunk)`` holds much more than ``rows_per_task`` rows.

    ``order_by`` should identify a row within its series: rows with one and the
    same order key always share a chunk.
    """
    by, order_by = tuple(by), tuple(order_by)
    hot = hot_series(df, by, rows_per_task, total)
    if hot is None:
        return Chunks(df.withColumn(CHUNK, F.lit(0)), by, order_by, 0)
    key = _key(df, order_by)
    fraction = min(1.0, SAMPLE_PER_CHUNK / rows_per_task)
    step = max(1, round(fraction * rows_per_task))
    sample = rows_of(df, by, hot).select(*[F.col(f"`{c}`").alias(_key_name(c)) for c in by], key.alias("__at"))
    if fraction < 1:
        sample = sample.sample(fraction=fraction, seed=7)
    # A list has SAMPLE_PER_CHUNK entries for each chunk of its series.
    listed = sample.groupBy(*map(_key_name, by)).agg(F.sort_array(F.collect_list("__at")).alias("__all"))
    places = F.when(F.size("__all") > step, F.sequence(F.lit(step), F.size("__all") - 1, F.lit(step)))
    bounds = listed.select(*map(_key_name, by), F.array_distinct(F.transform(
        F.coalesce(places, F.array().cast("array<int>")), lambda i: F.get("__all", i))).alias("__bounds"))
    path = scratch_path(df.sparkSession, "bounds")
    bounds.write.parquet(path)
    bounds = df.sparkSession.read.parquet(path)
    most = bounds.agg(F.max(F.size("__bounds"))).first()[0] or 0
    return Chunks(_assign(df, by, key, bounds, hot, most), by, order_by, hot.chunks)


def _key(df: DataFrame, names: Sequence[str]) -> Column:
    """The columns as one comparable value in window order: null first, instants as numbers."""
    fields = []
    for i, c in enumerate(names):
        dtype, column = df.schema[c].dataType, F.col(c)
        if isinstance(dtype, (TimestampType, TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        elif isinstance(dtype, DateType):
            column = F.unix_date(column)
        elif isinstance(dtype, BinaryType):
            column = F.hex(column)
        fields.append(column.alias(f"k{i}"))
    return F.struct(*fields)


def _assign(df: DataFrame, by: tuple[str, ...], key: Column, bounds: DataFrame, hot: Hot, most: int) -> DataFrame:
    """Add CHUNK: 0 for rows without bounds, else 1 more than the number of bounds <= the row's key.

    A binary search in the series' sorted bounds, at most ``most``, right where they are joined.
    """
    names = [f"`{c}`" for c in df.columns]
    # Without a series there is one row of bounds, for all rows.
    joined = df.join(_sized(bounds, hot.chunks if by else 1), _same(by), "left")
    steps = F.array(*[F.lit(2 ** i) for i in reversed(range(max(1, int(most).bit_length())))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size("__bounds")) & (F.get("__bounds", at + step - 1) <= key), at + step).otherwise(at))
    return joined.select(*names, F.when(F.col("__bounds").isNull(), 0).otherwise(found + 1).alias(CHUNK))


def _carry(chunks: Chunks, rows: DataFrame, aggs: Sequence[Column],
           over: Callable[[object], Sequence[Column]]) -> DataFrame:
    """What flows into a chunk of a hot series: aggregates folded over its earlier chunks.

    Only hot rows are read. The first chunk of a series receives nothing and is left
    out. There is a row for each chunk.
    """
    summary = rows.filter(chunks.hot).groupBy(*chunks.by, CHUNK).agg(*aggs)
    fold = Window.partitionBy(*(chunks.by or (F.lit(0),))).orderBy(CHUNK)
    before = fold.rowsBetween(Window.unboundedPreceding, -1)
    folded = summary.select(*chunks.by, CHUNK, *over(before))
    return folded.filter(F.col(folded.columns[-1]).isNotNull())


def _join_carry(chunks: Chunks, rows: DataFrame, carry: DataFrame) -> DataFrame:
    keys = (*chunks.by, CHUNK)
    renamed = carry.withColumnsRenamed({c: _key_name(c) for c in keys})
    return rows.join(_sized(renamed, chunks.chunks), _same(keys), "left").drop(*map(_key_name, keys))


def running_sum(chunks: Chunks, rows: DataFrame, value: Column, name: str,
                ties_together: bool = False) -> DataFrame:
    """Running total of ``value`` in series order.

    ``ties_together`` gives all rows of one order key the total including all of
    them (SQL's default RANGE frame) instead of a row-by-row total.
    """
    window = chunks.window
    if not ties_together:
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn(name, F.sum(value).over(window))
    if not chunks.split:
        return local
    carry = _carry(chunks, rows, [F.sum(value).alias("__sum")],
                   lambda before: [F.sum("__sum").over(before).alias("__offset")])
    return (_join_carry(chunks, local, carry)
            .withColumn(name, F.col(name) + F.coalesce(F.col("__offset"), F.lit(0)))
            .drop("__offset"))


def positions(chunks: Chunks, rows: DataFrame, name: str = POSITION) -> DataFrame:
    """1-based ordinal of every row in its series."""
    local = rows.withColumn(name, F.row_number().over(chunks.window).cast("bigint"))
    if not chunks.split:
        return local
    carry = _carry(chunks, rows, [F.count(F.lit(1)).alias("__n")],
                   lambda before: [F.sum("__n").over(before).alias("__offset")])
    return (_join_carry(chunks, local, carry)
            .withColumn(name, F.col(name) + F.coalesce(F.col("__offset"), F.lit(0)))
            .drop("__offset"))


def previous(chunks: Chunks, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Value of the leading order column on the preceding row of the series.

    ``column`` must be ``order_by[0]``: its value on the row before a chunk is
    then the maximum of the nearest earlier chunk that has one.
    """
    if column != chunks.order_by[0]:
        raise ValueError("previous() follows the leading order column")
    local = rows.withColumn(name, F.lag(column).over(chunks.window))
    if not chunks.split:
        return local
    first = F.row_number().over(chunks.window) == 1
    carry = _carry(chunks, rows, [F.max(column).alias("__max")],
                   lambda before: [F.last("__max", ignorenulls=True).over(before).alias("__carried")])
    return (_join_carry(chunks, local.withColumn("__first", first), carry)
            .withColumn(name, F.when(F.col("__first"), F.col("__carried")).otherwise(F.col(name)))
            .drop("__first", "__carried"))


def per_series(df: DataFrame, by: Sequence[str], order_by: Sequence[str], reach: int,
               compute: Callable[[DataFrame, Sequence[str]], DataFrame],
               rows_per_task: int = ROWS_PER_TASK, drop_repeated: bool = True) -> DataFrame:
    """Run a bounded-reach computation over every series, hot ones in blocks.

    ``compute(rows, keys)`` sees rows clustered by ``keys`` (the series and its
    block) and sorted, with POSITION in the series, ``__index`` in the block and
    ``__own``. It may look at most ``reach`` rows back and must keep ``keys`` and
    POSITION. Ordinary series are one block. A hot series becomes blocks of
    consecutive positions, each preceded by the ``reach`` rows before it. Those
    repeated rows are not ``__own``; their results are dropped afterwards unless
    ``compute`` leaves them out itself.
    """
    chunks = cut(df, by, order_by, rows_per_task)
    keys = (*by, "__block")
    cold = chunks.df.filter(~chunks.hot) if chunks.split else chunks.df
    order = Window.partitionBy(*keys).orderBy(*order_by)
    cold = (cold.drop(CHUNK).withColumn("__block", F.lit(0).cast("bigint"))
            .withColumn(POSITION, F.row_number().over(order).cast("bigint"))
            .withColumns({"__index": F.col(POSITION), "__own": F.lit(True)}))
    extra = ("__block", "__index", "__own")
    if not chunks.split:
        return compute(cold, keys).drop(*extra)

    length = max(rows_per_task, 2 * reach)
    home = F.floor((F.col(POSITION) - 1) / F.lit(length))
    into_next = F.col(POSITION) > (home + 1) * length - reach
    start = F.greatest(F.col("__block") * length - reach, F.lit(0))
    own = F.floor((F.col(POSITION) - 1) / F.lit(length)) == F.col("__block")
    hot = (positions(chunks, chunks.df.filter(chunks.hot)).drop(CHUNK)
           .withColumn("__block", F.explode(
               F.when(into_next, F.array(home, home + 1)).otherwise(F.array(home))))
           .withColumns({"__index": F.col(POSITION) - start, "__own": own})
           .repartition(*keys).sortWithinPartitions(*keys, *order_by))
    blocked = compute(hot, keys)
    if drop_repeated:
        blocked = blocked.filter(own)
    if not by:
        return blocked.drop(*extra)
    return compute(cold, keys).unionByName(blocked).drop(*extra)
