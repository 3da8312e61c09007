"""Periodic runs of words inside documents, by seeds and diagonals.

A run is a stretch of words with smallest period ``q``, at least ``max(least, times * q)`` long,
that neither neighbouring word extends. Words ``q`` apart match over its length less ``q``, so a
run holds a seed: two equal grams of ``seed_words(least, times)`` words, ``q`` apart. Grams are
indexed by hash within each document, and pairs of their occurrences are extended along their
diagonal, word by word.

Two things keep a gram with many occurrences from giving all its pairs. The first seed of a
diagonal's stretch has different words before its two grams, so only such pairs are listed, and
nothing is left to extend before them: an occurrence inside a run has the same word before it as
the run's other occurrences. And a table says for each lag how far its diagonal is covered, in the
order of the seeds' places: a run of period ``q`` covers its multiples too, whose stretch is the same.

Words are runs of bytes other than space and 0x09-0x0D. A null text has no words. One document is
the unit of work, whatever its length; a task holds a bounded number of documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import mix, slices

FACTOR = np.uint64(0x9E3779B97F4A7C15)
Words = list[bytes]
Run = tuple[int, int, int]


def seed_words(least: int, times: int) -> int:
    """The longest gram that the overlap of every run with itself is sure to hold."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on, by doubling."""
    out, size = mix(ids.astype(np.uint64) + FACTOR), 1
    while size < k:
        by = min(size, k - size)
        out = mix(out[:len(out) - by] * FACTOR + out[by:])
        size += by
    return out


def _extend(ids: np.ndarray, left: int, lag: int) -> int:
    """End of the stretch in which words ``lag`` apart match, from ``left`` on."""
    at, step = left, 64
    while at < len(ids) - lag:
        stop = min(at + step, len(ids) - lag)
        differ = np.flatnonzero(ids[at:stop] != ids[at + lag:stop + lag])
        if len(differ):
            return at + int(differ[0]) + lag
        at, step = stop, step * 2
    return len(ids)


def _seeds(places: np.ndarray, before: np.ndarray, grams: np.ndarray, n: int, k: int, least: int,
           times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one gram's ``places`` (ascending) that may begin a run: (left place, lag)."""
    kinds, kind = np.unique(before, return_inverse=True)
    common = int(np.argmax(np.bincount(kind)))
    for t in np.flatnonzero(kind != common):
        others = places[kind != kind[t]]
        left, lag = np.minimum(others, places[t]), np.abs(others - places[t])
        fits = left + np.maximum(times * lag, least) <= n
        left, lag = left[fits], lag[fits]
        # A long period holds whole grams ``times`` times over.
        for m in range(2, times):
            there = (times - m) * lag >= k
            same = np.ones(len(left), bool)
            same[there] = grams[left[there] + m * lag[there]] == grams[left[there]]
            left, lag = left[same], lag[same]
        if len(left):
            yield left, lag


def find_runs(ids: np.ndarray, grams: np.ndarray, least: int, times: int) -> list[Run]:
    """(start, length, period) of all runs of a document, by start and period.

    ``grams``: hashes of its grams of ``seed_words(least, times)`` words.
    """
    n, k = len(ids), seed_words(least, times)
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else np.empty(0, int)
    ends = np.r_[starts[1:], len(order)].astype(int)
    if not (ends - starts > 1).any():
        return []
    before = np.where(order > 0, ids[order - 1], -1)
    # Only grams that follow on different words can begin a stretch.
    open_ = np.minimum.reduceat(before, starts) != np.maximum.reduceat(before, starts)
    pairs = [pair for a, b in zip(starts[open_], ends[open_])
             for pair in _seeds(order[a:b], before[a:b], grams, n, k, least, times)]
    if not pairs:
        return []
    left, lag = (np.concatenate(x) for x in zip(*pairs))
    covered: dict[int, int] = {}
    found: dict[tuple[int, int], int] = {}
    for at in np.lexsort((lag, left)):
        start, q = int(left[at]), int(lag[at])
        if start < covered.get(q, 0):
            continue
        end = _extend(ids, start, q)
        covered[q] = end - q
        if end - start >= max(least, times * q):
            found.setdefault((start, end), q)
            for multiple in range(2 * q, (end - start) // times + 1, q):
                covered[multiple] = max(covered.get(multiple, 0), end - multiple)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Places outside the repeats: of each run, its first period stays."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.flatnonzero(np.cumsum(steps[:n]) == 0)


def repeat_words(words: Words, doc_id: int | None) -> Words:
    """In a tenth of the documents, by the hash of their id, words from some place on repeat."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + (part * -(-(n - a) // p))[:n - a]


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()), ("runs", pa.list_(pa.struct([
        ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])


def _report(doc_id: int | None, words: Words, runs: list[Run], texts: bool) -> list:
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = b" ".join([words[i] for i in kept_words(len(words), runs)] if runs else words)
    listed = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    return [doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
            [dict(zip(("start", "length", "period"), r)) for r in runs], kept if texts else None]


def _find(least: int, times: int, edit: Callable[[Words, int | None], Words] | None, texts: bool):
    k = seed_words(least, times)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, numbers, rows = {}, batch.column(0).to_pylist(), []
            for doc_id, text in zip(numbers, batch.column(1)):
                words = text.as_py().split() if text.is_valid else []
                words = edit(words, doc_id) if edit else words
                runs: list[Run] = []
                if len(words) >= least:
                    # Numbers of the words of these rows, exact ones: hashes only propose seeds.
                    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
                    runs = find_runs(codes, gram_hashes(codes, k), least, times)
                rows.append(_report(doc_id, words, runs, texts))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)]
            yield pa.RecordBatch.from_arrays(columns, schema=OUT)
    return each


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, texts: bool = True,
                  edit: Callable[[Words, int | None], Words] | None = None) -> DataFrame:
    """A row per document: its runs, the one with most repeats, and its text without repeats.

    Of runs with equal length over period, the first counts, then the shortest period; without
    runs ``start``, ``length``, ``period`` and ``exponent_milli`` are null. ``runs_sha256`` is of
    the lines ``start,length,period`` by start and period, ``collapsed_sha256`` of ``collapsed``:
    the words outside the repeats, joined by one space (null unless ``texts``). ``edit`` may
    change a document's words first. Rows are independent, so repeated rows and null ids count as
    documents of their own; columns other than ``doc_id`` and ``text`` are left out.
    """
    schema = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              "runs_sha256 string, collapsed_sha256 string, "
              "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    found = rows.mapInArrow(_find(least, times, edit, texts), schema)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
