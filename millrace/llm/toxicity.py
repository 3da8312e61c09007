"""Toxicity by a classifier chain.

A chain has one linear model for each category, in order. Model k sees the words of a text and
the probabilities of categories 1 to k-1. It is trained with out-of-fold probabilities, given
by models that had not seen the text, so that it learns to trust them as far as they deserve.

A text's features are its distinct words and their beginnings. Few of them tell anything: a
fit uses those whose share differs between the two classes of its own training rows by several
standard errors. Models are fitted on a bounded sample of labelled texts (``sample_rows``);
each fold is a task of its own. Every text is scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import WordHashes, slices, written

PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


#: Lengths in bytes of the beginnings of words that are features.
BEGINNINGS = (3, 4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Chain:
    """``vocabulary``: sorted feature hashes. For each category: weights of the features, of the
    earlier probabilities, the intercept, and the probability from which it holds."""
    categories: tuple[str, ...]
    vocabulary: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercepts: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, places: np.ndarray) -> np.ndarray:
        """Of a text, given the places of its features in the vocabulary."""
        sums = self.weights[:, places].sum(axis=1) + self.intercepts
        out = np.zeros(len(self.categories))
        for k in range(len(out)):
            out[k] = _sigmoid(sums[k] + self.earlier[k, :k] @ out[:k])
        return out


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return text.lower().translate(PUNCTUATION).split()


class FeatureHashes(WordHashes):
    """Word to the hashes of its features: itself and its beginnings."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        parts = [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) >= n)]
        self[word] = found = b"".join(map(xxhash.xxh3_64_digest, parts))
        return found


class KnownFeatures(FeatureHashes):
    """Word to the places of its features in a vocabulary, four bytes each; mostly none."""

    def __init__(self, vocabulary: np.ndarray):
        super().__init__()
        self.known = {h.tobytes(): p.tobytes() for h, p in zip(
            vocabulary.astype("<u8"), np.arange(len(vocabulary), dtype="<u4"))}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        get, digest = self.known.get, xxhash.xxh3_64_digest
        found = get(digest(word), b"")
        for n in BEGINNINGS:
            if len(word) < n:
                break
            found += get(digest(word[:n] + b"*"), b"")
        self[word] = found
        return found


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(rows: np.ndarray, columns: np.ndarray, n_columns: int, extra: np.ndarray, y: np.ndarray,
                 penalty: float = 0.3, steps: int = 150) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of binary features (entries at ``rows, columns``), of ``extra`` and intercept.

    Logistic loss with a squared penalty, by Adam on the whole sample.
    """
    n = len(y)
    rate = (y.sum() + 0.5) / (n + 1)
    theta = np.zeros(n_columns + extra.shape[1] + 1)
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        score = np.bincount(rows, theta[columns], n) + extra @ theta[n_columns:-1] + theta[-1]
        error = _sigmoid(score) - y
        slope = np.concatenate([np.bincount(columns, error[rows], n_columns), error @ extra, [error.sum()]])
        slope[:-1] += penalty * theta[:-1]
        slope /= n
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        theta -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return theta[:n_columns], theta[n_columns:-1], float(theta[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which calling a text positive has the best F1; over 1 if no text
    of the sample is positive. It lies in the middle of the gap below the texts it calls."""
    if not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[:-1] == p[1:]] = -1  # ties are called together
    best = int(np.argmax(f1))
    below = p[best + 1] if best + 1 < len(p) else 0.0
    return float((p[best] + below) / 2)


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Column], sample_rows: int = 8000,
              features: int = 20_000, folds: int = 4, least_texts: int = 3, errors: float = 4.0) -> Chain:
    """A chain for ``categories`` (name to a 0/1 column of ``labels``, in chain order).

    The sample holds about ``sample_rows`` labelled texts, chosen by a digest of their id. A
    fit's features are in at least ``least_texts`` texts of the sample and differ between the
    classes by at least ``errors`` standard errors; at most ``features`` in all, those that
    differ most. Null ids and null labels are left out; where an id has several labels, the
    largest holds.
    """
    names = list(categories)
    clean = (labels.where("doc_id is not null")
             .groupBy("doc_id").agg(*[F.max(c.cast("int")).alias(f"y_{k}") for k, c in enumerate(categories.values())])
             .na.drop())
    total = clean.count()
    # The same rate thins out both sides before they are joined.
    share = max(1, round(1e6 * min(1, sample_rows / max(total, 1))))
    kept = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(11)), F.lit(1_000_000)) < share
    joined = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(kept)
              .join(clean.where(kept), "doc_id"))
    ys = [f"y_{k}" for k in range(len(names))]
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(5)), F.lit(folds)).cast("int")
    joined = joined.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", fold.alias("fold"), *ys)
    schema = "doc_id bigint, features array<bigint>, fold int, " + ", ".join(f"{y} int" for y in ys)

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = FeatureHashes()
        for batch in slices(batches):
            found = [np.unique(np.frombuffer(b"".join(map(hashes.__getitem__, words_of(t))), "<i8"))
                     for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64())), *batch.columns[2:]],
                                             names=["doc_id", "features", "fold", *ys])

    sample = written(joined.mapInArrow(features_of, schema), "labelled")
    vocabulary, chosen = _telling_features(sample, ys, folds, features, least_texts, errors)
    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.array(x, np.int64).view(np.uint64) for x in batch.column(1).to_pylist()]
            few = [np.intersect1d(x, vocabulary).view(np.int64) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(few, pa.list_(pa.int64())), *batch.columns[2:]],
                                             names=batch.schema.names)

    # From here a text is its few features that tell something.
    known = written(sample.mapInArrow(telling, schema), "known").withColumn("p", F.array().cast("array<double>"))
    n = len(vocabulary)
    weights, earlier = np.zeros((len(names), n)), np.zeros((len(names), len(names)))
    intercepts, thresholds = np.zeros(len(names)), np.full(len(names), 2.0)
    for k in range(len(names)):
        # Task f < folds fits without fold f and rates it; task ``folds`` fits on all.
        tasks = known.select("doc_id", "features", "fold", "p", F.col(ys[k]).alias("y"),
                             F.explode(F.array(*[F.lit(f) for f in range(folds + 1)])).alias("task"))
        result = written(tasks.groupBy("task").applyInArrow(
            _fold_fit(vocabulary, chosen[k], folds, k), "doc_id bigint, q double, y int, model array<double>"), "chain")
        model = result.where("model is not null").select("model").first()
        if model is None:
            break
        theta = np.array(model[0])
        weights[k], earlier[k, :k], intercepts[k] = theta[:n], theta[n:n + k], theta[-1]
        rated = result.where("model is null")
        # As many pairs of numbers as the sample has rows.
        pairs = np.array([(r["q"], r["y"]) for r in rated.select("q", "y").collect()]).reshape(-1, 2)
        thresholds[k] = best_threshold(pairs[:, 0], pairs[:, 1])
        known = (known.join(rated.groupBy("doc_id").agg(F.first("q").alias("q")), "doc_id")
                 .withColumn("p", F.concat("p", F.array("q"))).drop("q"))
    used = (weights != 0).any(axis=0)
    return Chain(tuple(names), vocabulary[used], weights[:, used], earlier, intercepts, thresholds)


def _telling_features(sample: DataFrame, ys: list[str], folds: int, features: int, least_texts: int,
                      errors: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, and for each category and task which of them its training rows single out."""
    task_rows = [F.col("fold") != t if t < folds else F.lit(True) for t in range(folds + 1)]
    number = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    cells = [(k, t) for k in range(len(ys)) for t in range(folds + 1)]
    sums = ([number(rows).alias(f"n_{t}") for t, rows in enumerate(task_rows)]
            + [number(task_rows[t] & (F.col(ys[k]) == 1)).alias(f"p_{k}_{t}") for k, t in cells])
    whole = sample.agg(*sums).first()
    counts = sample.select(F.explode("features").alias("feature"), "fold", *ys).groupBy("feature").agg(*sums)
    scores = []
    for k, t in cells:
        n, p = float(whole[f"n_{t}"] or 0), float(whole[f"p_{k}_{t}"] or 0)
        if not 0 < p < n:
            scores.append(F.lit(0.0).alias(f"z_{k}_{t}"))
            continue
        hits, all_ = F.col(f"p_{k}_{t}"), F.col(f"n_{t}")
        spread = F.sqrt(all_ / n * (1 - all_ / n) * (1 / p + 1 / (n - p)))
        scores.append(F.when(spread > 0, F.abs(hits / p - (all_ - hits) / (n - p)) / spread).otherwise(0.0).alias(f"z_{k}_{t}"))
    rated = counts.where(F.col(f"n_{folds}") >= least_texts).select("feature", *scores)
    best = F.greatest(*[F.col(f"z_{k}_{t}") for k, t in cells], F.lit(0.0))
    rows = (rated.withColumn("best", best).where(F.col("best") >= errors)
            .orderBy(F.desc("best"), "feature").limit(features).collect())
    hashes = np.array([r["feature"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    chosen = np.array([[[r[f"z_{k}_{t}"] >= errors for r in rows] for t in range(folds + 1)] for k in range(len(ys))], bool)
    return hashes[order], chosen.reshape(len(ys), folds + 1, len(rows))[:, :, order]


def _fold_fit(vocabulary: np.ndarray, chosen: np.ndarray, folds: int, k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        task = key[0].as_py()
        features = table.column("features").combine_chunks()
        rows = np.repeat(np.arange(table.num_rows), np.diff(features.offsets.to_numpy()))
        columns = np.searchsorted(vocabulary, features.flatten().to_numpy().view(np.uint64))
        used = chosen[task][columns]
        rows, columns = rows[used], columns[used]
        y = table.column("y").to_numpy().astype(float)
        p = np.array([x or [] for x in table.column("p").to_pylist()], float).reshape(table.num_rows, k)
        held = table.column("fold").to_numpy() == task
        own = ~held[rows]
        place = np.cumsum(~held) - 1
        w, v, b = fit_logistic(place[rows[own]], columns[own], len(vocabulary), p[~held], y[~held])
        if task == folds:
            ids, q, labels, model = [None], [None], [None], [np.concatenate([w, v, [b]])]
        else:
            score = np.bincount(rows, w[columns], table.num_rows) + p @ v + b
            ids = table.column("doc_id").to_numpy()[held]
            q, labels, model = _sigmoid(score)[held], y[held].astype(int), [None] * int(held.sum())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "q": pa.array(q, pa.float64()),
                         "y": pa.array(labels, pa.int32()), "model": pa.array(model, pa.list_(pa.float64()))})

    return run


def rate(docs: DataFrame, chain: Chain) -> DataFrame:
    """All rows and columns of ``docs`` with ``ratings``: struct of ``p_<category>`` and
    ``is_<category>``. Null, empty and wordless texts are rated by the intercepts and hold no
    category. A column that is called ``ratings`` is replaced; repeated rows are rated alike."""
    names = [c for c in docs.columns if c != "ratings"]
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    # The models travel once per executor; their size is bounded by ``features``.
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = ", ".join([f"p_{c}: double" for c in chain.categories] + [f"is_{c}: boolean" for c in chain.categories])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = KnownFeatures(model.vocabulary)
        for batch in slices(batches):
            row = batch.column(0)
            texts = row.field("text").cast(pa.binary()).to_pylist()
            words = [words_of(t or b"") for t in texts]
            found = [np.unique(np.frombuffer(b"".join(map(known.__getitem__, w)), "<u4")) for w in words]
            p = np.array([model.probabilities(f) for f in found]).reshape(len(texts), len(model.categories))
            holds = (p >= model.thresholds) & np.array([len(w) > 0 for w in words], bool)[:, None]
            out = pa.StructArray.from_arrays(
                [pa.array(p[:, k]) for k in range(p.shape[1])] + [pa.array(holds[:, k]) for k in range(p.shape[1])],
                names=[f"p_{c}" for c in model.categories] + [f"is_{c}" for c in model.categories])
            yield pa.RecordBatch.from_arrays([row, out], names=["row", "ratings"])

    rated = kept.mapInArrow(run, f"row {kept.schema['row'].dataType.simpleString()}, ratings struct<{fields}>")
    return rated.select(*[F.col("row")[c].alias(c) for c in names], "ratings")


def toxicity_categories() -> dict[str, Column]:
    """The chain over the ``labels`` table: low quality first, then toxicity."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
