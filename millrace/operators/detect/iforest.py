"""Isolation forest: trees grown in parallel from bounded samples, scored in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.features import complete_rows
from millrace.operators.quantiles import quantiles
from millrace.operators.sizes import spread_if_small
from millrace.operators.sampling import fast_hash, sample_n

# Nodes are numbered as in a heap: the children of node i are 2i + 1 and 2i + 2.
NODE_SCHEMA = "tree int, node int, feature int, threshold double, depth int, size int"
# Rows walked through the trees at a time, so that the working arrays stay in cache.
ROWS_PER_WALK = 8_192
# Tasks that grow trees. Growing is short; a fixed number keeps it from being merged into one.
GROW_TASKS = 32
EULER = 0.5772156649


def path_length(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    average = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, average))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees as arrays [trees, nodes].

    Below a leaf every comparison goes left, so each row ends on the lowest level,
    where ``path`` holds the leaf's depth plus the expected path below it.
    """

    features: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    sample_size: int
    levels: int
    offset: float = -0.5

    def score_samples(self, rows: np.ndarray) -> np.ndarray:
        """Minus the anomaly score: close to -1 for outliers, above -0.5 for normal rows."""
        result = np.empty(len(rows))
        for at in range(0, len(rows), ROWS_PER_WALK):
            result[at:at + ROWS_PER_WALK] = self._walk(rows[at:at + ROWS_PER_WALK])
        return result

    def _walk(self, rows: np.ndarray) -> np.ndarray:
        values = np.ascontiguousarray(rows).ravel()
        first = np.arange(len(rows)) * rows.shape[1]
        total = np.zeros(len(rows))
        for feature, threshold, path in zip(self.feature, self.threshold, self.path):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.levels):
                above = values.take(first + feature.take(node)) > threshold.take(node)
                node *= 2
                node += 1
                node += above
            total += path.take(node)
        average = total / len(self.feature)
        return -np.exp2(-average / path_length(np.array([self.sample_size]))[0])

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """Minus the decision function: above 0 means outlier."""
        return self.offset - self.score_samples(rows)

    def score(self) -> Column:
        """Scalar Arrow UDF over the feature columns; null where a feature is missing."""
        forest = self

        @F.pandas_udf("double")
        def iforest_score(*columns: pd.Series) -> pd.Series:
            rows = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            result = forest.anomaly(np.nan_to_num(rows))
            return pd.Series(np.where(np.isnan(rows).any(axis=1), np.nan, result)).replace(
                {np.nan: None}).astype("float64")

        return iforest_score(*[F.col(c).cast("double") for c in self.features])


def _grow(tree: int, rows: np.ndarray, max_depth: int, seed: int) -> pd.DataFrame:
    """One isolation tree, level by level.

    A node takes a random feature that varies in it and a random cut between that
    feature's extremes; it stays a leaf if nothing varies or the depth is reached.
    """
    rng = np.random.default_rng([seed, tree])
    node, levels = np.zeros(len(rows), dtype=np.int64), []
    for depth in range(max_depth + 1):
        ids, member, sizes = np.unique(node, return_inverse=True, return_counts=True)
        order = np.argsort(member, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        low = np.minimum.reduceat(rows[order], starts, axis=0)
        high = np.maximum.reduceat(rows[order], starts, axis=0)
        varies = high > low
        feature = np.where(varies, rng.random(varies.shape), -1.0).argmax(axis=1)
        at = np.arange(len(ids)), feature
        cut = low[at] + rng.random(len(ids)) * (high[at] - low[at])
        cut = np.where(cut < high[at], cut, low[at])
        inner = varies.any(axis=1) & (depth < max_depth)
        levels.append(pd.DataFrame({
            "tree": tree, "node": ids, "feature": np.where(inner, feature, -1),
            "threshold": np.where(inner, cut, 0.0), "depth": depth, "size": sizes}))
        goes_on = inner[member]
        rows, member, node = rows[goes_on], member[goes_on], node[goes_on]
        if not len(rows):
            break
        above = rows[np.arange(len(rows)), feature[member]] > cut[member]
        node = 2 * node + 1 + above
    return pd.concat(levels, ignore_index=True)


def iforest_nodes(train: DataFrame, features: Sequence[str], keys: Sequence[str],
                  trees: int = 100, sample_size: int = 256, seed: int = 42) -> DataFrame:
    """Node table of the forest, one row per node.

    At most ``trees * sample_size`` rows are drawn once and dealt to the trees, so
    what follows the draw does not grow with the data. A table that is too small
    for disjoint samples is shuffled and dealt again, in as many rounds as needed.
    """
    max_depth = math.ceil(math.log2(max(sample_size, 2)))
    columns = list(features)
    rows = complete_rows(train, columns)
    total = rows.count()
    available = min(total, trees * sample_size)
    per_round = max(1, available // sample_size)
    rounds = math.ceil(trees / per_round)
    pool = sample_n(rows.select(*dict.fromkeys([*keys, *columns])), trees * sample_size, keys, seed,
                    portable=False, total=total)
    dealt = pool.select(
        *[F.col(c).cast("double").alias(c) for c in columns],
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("__round"))
    order = Window.partitionBy("__round").orderBy("__rank")
    drawn = (dealt.withColumn("__rank", fast_hash(["__round", *[f"__key_{k}" for k in keys]], seed))
             .withColumn("__n", F.row_number().over(order) - 1)
             .filter(F.col("__n") < per_round * sample_size)
             .withColumn("tree", (F.col("__round") * per_round
                                  + F.floor(F.col("__n") / sample_size)).cast("int"))
             .filter(F.col("tree") < trees))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("__rank")[columns].to_numpy(dtype=float)
        return _grow(int(pdf["tree"].iloc[0]), rows, max_depth, seed)

    return (drawn.select("tree", "__rank", *columns).repartition(min(trees, GROW_TASKS), "tree")
            .groupBy("tree").applyInPandas(grow, NODE_SCHEMA))


def forest_from_nodes(nodes: pd.DataFrame, features: Sequence[str], offset: float = -0.5) -> Forest:
    """Forest from its node table (at most 2 * sample_size rows per tree)."""
    trees = sorted(nodes["tree"].unique())
    levels = int(nodes["depth"].max())
    shape = (len(trees), 2 ** (levels + 1) - 1)
    feature, threshold = np.zeros(shape, dtype=np.int64), np.full(shape, np.inf)
    path = np.zeros(shape)
    for t, tree in enumerate(trees):
        rows = nodes[nodes["tree"] == tree]
        at, inner = rows["node"].to_numpy(), rows["feature"].to_numpy() >= 0
        feature[t, at[inner]] = rows["feature"].to_numpy()[inner]
        threshold[t, at[inner]] = rows["threshold"].to_numpy()[inner]
        leaf, depth = at[~inner], rows["depth"].to_numpy()[~inner]
        length = depth + path_length(rows["size"].to_numpy()[~inner])
        lowest = (leaf + 1) * 2 ** (levels - depth) - 1
        path[t, lowest] = length
    sample = int(nodes.loc[nodes["node"] == 0, "size"].max())
    return Forest(tuple(features), feature, threshold, path, sample, levels, offset)


def iforest_fit(train: DataFrame, features: Sequence[str], keys: Sequence[str], trees: int = 100,
                contamination: float = 0.05, sample_size: int = 256, seed: int = 42) -> Forest:
    """Forest whose offset makes ``contamination`` of the training rows outliers.

    The node table is at most ``trees * 2 * sample_size`` rows. The offset is an
    exact quantile of the training scores, taken on Spark over all rows.
    """
    nodes = iforest_nodes(train, features, keys, trees, sample_size, seed).toPandas()
    forest = forest_from_nodes(nodes, features, offset=0.0)
    rows = complete_rows(train, features).select(*features)
    scored = spread_if_small(rows, rows.count()).select((-forest.score()).alias("score"))
    offset = quantiles(scored, "score", [contamination])[0]
    return forest_from_nodes(nodes, features, offset=offset)
