"""Spelling variants: words of a corpus that differ by one letter, grouped below the frequent one.

Words are counted over all documents. Two words are near if one inserted, deleted or replaced
letter makes them equal, that is, if their common prefix and their common suffix together reach
the longer length less one. Words are dealt to tiles: a tile holds the words that agree in all but
a window of ``WINDOW`` letters, so it is bounded by the alphabet, whatever the corpus. Inside, padded
letter matrices of blocks of words are compared with each other, prefix and suffix at once; each
near pair is found in one tile only, and leaves as one row a word with the number of its near
words and the best of them, not as pairs.

Null texts have no words. Repeated rows count as often as they occur. Letters are A-Z, a-z and
U+00C0 to U+00FF, so a word is one byte a letter in Latin-1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import shuffle_width, slices, written

RUN = re.compile(rb"[a-z\xc0-\xff]+")
# Distinct words that a task counts before it passes them on.
MOST_WORDS = 100_000
# Letters in which the words of a tile may differ; wider for words beyond WINDOW * MOST_TILES letters.
WINDOW, MOST_TILES = 2, 64
# Rows that are compared at a time, and the bytes that one comparison of blocks may take.
ROWS, BLOCK, BYTES = 20_000, 32, 1 << 22


def _slip(doc_id: int | None, word: bytes, every: int, seed: int) -> bytes:
    """``word`` without one letter, if ``every`` divides the hash of document and word.

    ``seed``: the checksum of the document's part.
    """
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _tally(least: int, every: int | None):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], schema=schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                # Letters beyond Latin-1 end a run, as the question mark does that stands for them.
                seed = zlib.crc32(f"{doc_id}:".encode())
                for word in RUN.findall(text.as_py().encode("latin-1", "replace").lower()):
                    if every and doc_id is not None:
                        word = _slip(doc_id, word, every, seed)
                    if len(word) >= least:
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > MOST_WORDS:
                    yield out(counts)
                    counts = {}
        if counts:
            yield out(counts)
    return each


def word_counts(docs: DataFrame, letters: int = 5, least: int = 3, slip_every: int | None = None) -> DataFrame:
    """``word``, ``n``: words of at least ``letters`` letters that occur ``least`` times or more.

    With ``slip_every`` a word loses a letter in documents chosen by hash, as test material; a
    document without an id is left as it is.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    counted = rows.mapInArrow(_tally(letters, slip_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _tiles(word: Column) -> Column:
    """Tiles of a word: ``longer`` (length of a pair's longer word), first letter ``at`` and
    ``width`` of the window in which the pair's edit lies, ``tile`` (hash of all but the window)."""
    def of(longer: Column) -> Column:
        width = F.greatest(F.lit(WINDOW), F.ceil(longer / MOST_TILES).cast("int"))

        def tile(at: Column) -> Column:
            # The last window ends with the word.
            own = F.least(width, longer - at)
            rest = longer - at - own
            tail = F.substring(word, F.length(word) - rest + 1, rest)
            return F.struct(longer.alias("longer"), at.alias("at"), own.alias("width"),
                            F.xxhash64(longer, at, F.substring(word, F.lit(1), at), tail).alias("tile"))
        return F.transform(F.sequence(F.lit(0), longer - 1, width), tile)
    return F.flatten(F.transform(F.array(F.length(word), F.length(word) + 1), of))


def _agree(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Letters in which rows of ``left`` agree with rows of ``right`` from the first one on.

    [blocks, rows, letters] each; [blocks, rows, rows]. Equal rows give 0.
    """
    return (left[:, :, None, :] == right[:, None, :, :]).argmin(axis=3)


def _near_pairs(tile: np.ndarray, at: np.ndarray, width: np.ndarray, short: np.ndarray, front: np.ndarray,
                back: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of rows in tile order, whose words have one length or (``short``) a letter less.

    ``front``, ``back``: the words' letters, from the left and from the right, padded.
    """
    n, longer = front.shape
    rows = max(1, min(BLOCK, int((BYTES / longer) ** 0.5)))
    count = -(-n // rows)
    padded = np.arange(count * rows).reshape(count, rows)
    real, padded = padded < n, np.minimum(padded, n - 1)
    first, last = tile[padded[:, 0]], tile[padded[:, -1]]
    some = max(1, BYTES // (rows * rows * longer))
    for apart in range(count):
        # A tile that goes on in a later block: these two blocks meet.
        meet = np.flatnonzero(last[:count - apart] == first[apart:]) if apart else np.arange(count)
        if not len(meet):
            break
        for cut in range(0, len(meet), some):
            a, b = padded[meet[cut:cut + some]], padded[meet[cut:cut + some] + apart]
            prefix, suffix = _agree(front[a], front[b]), _agree(back[a], back[b])
            place = np.maximum(0, longer - 1 - suffix)
            left, right = a[:, :, None], b[:, None, :]
            near = (prefix + suffix >= longer - 1) & (tile[left] == tile[right]) & (at[left] == at[right])
            near &= real[meet[cut:cut + some]][:, :, None] & real[meet[cut:cut + some] + apart][:, None, :]
            # One edit can lie in several places of equal letters; the pair belongs to the first one's tile.
            near &= (left < right) & (place >= at[left]) & (place < (at + width)[left]) & ~(short[left] & short[right])
            block, i, j = np.nonzero(near)
            yield a[block, i], b[block, j]


def _compare(table: pa.Table) -> pa.RecordBatch | None:
    """``word``, ``n_near``, ``best_n``, ``best``: each word's near words within whole tiles."""
    tile = table.column("tile").to_numpy()
    # Most tiles hold one word.
    same = tile[1:] == tile[:-1]
    alone = ~(np.r_[False, same] | np.r_[same, False])
    table = table.filter(pa.array(~alone))
    if not table.num_rows:
        return None
    tile, at, width, longer, n = (table.column(c).to_numpy() for c in ("tile", "at", "width", "longer", "n"))
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    pairs = []
    for size in np.unique(longer):
        own = np.flatnonzero(longer == size)
        front = np.array([words[i] for i in own], f"S{size}").view(np.uint8).reshape(len(own), size)
        back = np.array([words[i][::-1] for i in own], f"S{size}").view(np.uint8).reshape(len(own), size)
        short = front[:, -1] == 0
        for i, j in _near_pairs(tile[own], at[own], width[own], short, front, back):
            pairs += [(own[i], own[j]), (own[j], own[i])]
    left, right = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.empty(0, int),) * 2
    if not len(left):
        return None
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[right], -n[right], left))
    left, right = left[order], right[order]
    head = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
    counts = np.diff(np.r_[head, len(left)])
    return pa.RecordBatch.from_arrays([
        pa.array([words[i].decode("latin-1") for i in left[head]], pa.string()), pa.array(counts, pa.int64()),
        pa.array(n[right[head]], pa.int64()), pa.array([words[i].decode("latin-1") for i in right[head]], pa.string())],
        schema=NEAR)


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches come in order of length and tile; a tile may go on in the next batch."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        table = pa.Table.from_batches(held)
        tile = table.column("tile").to_numpy()
        whole = int(np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])[-1])
        if whole and (out := _compare(table.slice(0, whole))) is not None:
            yield out
        held = table.slice(whole).to_batches()
        rows -= whole
    if rows and (out := _compare(pa.Table.from_batches(held))) is not None:
        yield out


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: near words of ``words`` (``word``, ``n``).

    ``best`` occurs most; ties go to the first in code-point order. Words without any are left out.
    """
    width = shuffle_width(words.sparkSession)
    dealt = words.select("word", "n", F.explode(_tiles(F.col("word"))).alias("t")).select("word", "n", "t.*")
    tiles = dealt.repartition(width, "tile").sortWithinPartitions("longer", "tile", "at", "word")
    found = tiles.mapInArrow(_compare_tiles, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best")


def last_forms(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of ``forms`` (``word``, ``form``) from each word.

    Every round doubles the steps that a word has gone. A form occurs at least twice as often as
    its word, so a chain has at most 63 steps and there are at most seven rounds.
    """
    hops = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-hops")
    while hops.where("moved").limit(1).count():
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        hops = written(hops.drop("moved").join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
            "spelling-hops")
    return hops.drop("moved")


def spelling_forms(docs: DataFrame, letters: int = 5, least: int = 3, ratio: int = 2,
                   slip_every: int | None = None) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every counted word.

    ``form`` is the near word that occurs most (ties: first in code-point order), if it occurs at
    least ``ratio`` times as often, else null; ``root`` is the last form from form to form, the
    word itself if it has none.
    """
    words = written(word_counts(docs, letters, least, slip_every), "spelling-words")
    known = F.col("best_n") >= ratio * F.col("n")
    judged = written(words.join(near_words(words), "word", "left").select(
        "word", F.when(known, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(known, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = last_forms(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
