"""Packing tokenised documents into fixed sequences by best-two-fit.

A sequence is filled greedily with the largest piece that fits. If a gap stays, its smallest
piece gives way to two unpacked pieces that together fill the widened gap more tightly.

Lengths are whole numbers up to the capacity, so the fill needs to know only how many pieces
of each length there are: a table of at most ``capacity`` rows, whatever the corpus. The plan
made from it says "so many sequences of this pattern"; its size depends on the capacity alone.
Each piece then finds its place from its rank among the pieces of its length. Ranks are dealt
out over salted groups, so a length that a third of all pieces has is no hot group.
"""

from __future__ import annotations

import bisect
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import shuffle_width, slices, written

TASK_ROWS, TASK_BYTES = 4_096, 1 << 23


def best_two_fit(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Plan for ``counts`` pieces of each length, and the number of sequences.

    Plan rows, sorted: length, first rank, pieces of this length in one sequence, first
    sequence, place of the first such piece in the sequence.
    """
    left = np.zeros(capacity + 1, np.int64)
    left[list(counts)] = list(counts.values())
    sizes = np.flatnonzero(left).tolist()
    used_up = np.zeros(capacity + 1, np.int64)
    plan, sequences = [], 0
    while sizes:
        taken, gap = {}, capacity
        at = bisect.bisect_right(sizes, gap)
        while at and gap:
            at = min(at, bisect.bisect_right(sizes, gap))
            if not at:
                break
            size = sizes[at - 1]
            n = min(gap // size, int(left[size]))
            taken[size] = n
            gap -= n * size
            at -= 1
        peak = dict(taken)
        if gap:
            smallest = min(taken)
            pair = _tighter_pair(left, taken, gap + smallest, smallest)
            if pair:
                taken[smallest] -= 1
                for size in pair:
                    taken[size] = taken.get(size, 0) + 1
                    peak[size] = max(peak.get(size, 0), taken[size])
        times = min(int(left[s]) // n for s, n in peak.items())
        place = 0
        for size in sorted((s for s, n in taken.items() if n), reverse=True):
            n = taken[size]
            plan.append((size, int(used_up[size]), n, sequences, place))
            place += n * size
            used_up[size] += n * times
            left[size] -= n * times
            if not left[size]:
                sizes.remove(size)
        sequences += times
    plan.sort()
    return np.array(plan, np.int64).reshape(-1, 5), sequences


def _tighter_pair(left: np.ndarray, taken: dict, room: int, beat: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum up to ``room`` and over ``beat``."""
    rest = left[:room].copy()
    for size, n in taken.items():
        if size < room:
            rest[size] -= n
    free = np.flatnonzero(rest)
    if not len(free):
        return None
    other = np.searchsorted(free, np.minimum(room - free, free), side="right") - 1
    other -= (other == np.arange(len(free))) & (rest[free] < 2)
    sums = np.where(other >= 0, free + free[other], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    if sums[best] <= beat:
        return None
    return int(free[best]), int(free[other[best]])


#: How the tokenizer splits what lies between white space, once in lower case; and the ends of words.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
#: The same for words of printable ASCII in lower case.
ASCII_PIECE = r"('s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+)"


def _gather(values: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``pick`` of ``values``, one after another, and their sizes."""
    starts, n = np.cumsum(sizes) - sizes, sizes[pick]
    moved = starts[pick] - (np.cumsum(n) - n)
    return values[np.arange(n.sum()) + np.repeat(moved, n)], n


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, sizes = zip(*parts)
    return np.concatenate(values), np.concatenate(sizes)


def _sums(numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the first, the next and so on ``counts`` numbers."""
    ends, total = np.cumsum(counts), np.r_[0, np.cumsum(numbers)]
    return total[ends] - total[ends - counts]


class _Encoder:
    """Token ids of texts, word by word.

    The tokenizer drops white space and never joins words across it, nor the pieces that its
    pattern splits a word into. So the ids of a text are those of its words, and those of a
    word are those of its pieces. Each distinct word of a call is split once; pieces are looked up in
    a table, from which those that the last call did not have go when it grows too large. Those that are
    not known go to the tokenizer's model many at a time, without its normalizer and pattern: each
    ends with a token that closes a piece.
    Words that the tokenizer treats as a whole (special tokens, text that it normalizes in
    other ways than lower case, characters that it does not split as ``PRETOKEN`` does) are given to it alone.
    """

    def __init__(self, definition: str, pieces: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        split = [{"type": "WhitespaceSplit"},
                 {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        self.model = Tokenizer.from_str(json.dumps(json.loads(definition) | {
            "normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": split}, "added_tokens": []}))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.limit = pieces
        # Characters known so far, and those that words are not split at by ``PRETOKEN``. What sigma
        # becomes depends on what is beside it.
        self.seen, self.odd = set(), {"\u03a3", "\u0130"}
        self.forget()

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = [code.ids for code in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(codes), np.uint32), np.fromiter(map(len, codes), np.int64, len(codes))

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.empty(0, np.uint32), np.empty(0, np.int64))]
        for at in range(0, len(pieces), 500):
            part = pieces[at:at + 500]
            code, = self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(code.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            found.append((ids, np.diff(ends, prepend=0)) if len(ends) == len(part) else self._whole(part))
        return _joined(found)

    def _look(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and how many each has."""
        at = pc.index_in(pieces, value_set=self.known)
        fresh, new = pieces.filter(at.is_null()), np.flatnonzero(at.is_null())
        at = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[new] = len(self.known) + np.arange(len(new))
        codes = _joined([self.codes, self._learn(fresh.to_pylist())])
        own = _gather(*codes, at)
        if len(self.known) + len(fresh) > self.limit:
            self.known, self.codes = pieces, own
        else:
            self.known, self.codes = pa.concat_arrays([self.known, fresh]), codes
        return own

    def _ascii(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of printable words, and how many each has."""
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(words), ASCII_PIECE, r"\1 "))
        pieces, counts = split.flatten().dictionary_encode(), split.value_lengths().to_numpy()
        ids, n = _gather(*self._look(pieces.dictionary), pieces.indices.to_numpy())
        return ids, _sums(n, counts)

    def _other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without a line feed, and how many each has."""
        found = pa.array([*PRETOKEN.findall("\n".join(words).lower()), "\n"] if words else [], pa.string())
        ends = pc.equal(found, "\n").to_numpy(zero_copy_only=False)
        pieces = found.filter(pa.array(~ends)).dictionary_encode()
        ids, n = _gather(*self._look(pieces.dictionary), pieces.indices.to_numpy())
        return ids, _sums(n, np.diff(np.cumsum(~ends)[ends], prepend=0))

    def forget(self) -> None:
        """Empty the table: the worker lives on after its task."""
        # Arrow's splits leave empty strings.
        self.known, self.codes = pa.array([""]), (np.empty(0, np.uint32), np.zeros(1, np.int64))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words, counts = split.flatten().dictionary_encode(), split.value_lengths().to_numpy()
        distinct = words.dictionary
        ids, n = _gather(*self._distinct(distinct), words.indices.to_numpy())
        return ids, _sums(n, counts)

    def _judge(self, text: str) -> None:
        """Learn which characters the tokenizer lowers or splits in another way: its Unicode may be older."""
        for char in set(text) - self.seen:
            self.seen.add(char)
            sample = f"a{char}a !{char}!"
            lower = self.tokenizer.normalizer.normalize_str(sample)
            spans = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(lower)]
            if lower != sample.lower() or spans != [m.span() for m in PRETOKEN.finditer(lower)]:
                self.odd.add(char)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        simple = pc.and_(pc.ascii_is_printable(words), pc.invert(pc.match_substring(words, "<|")))
        kind = np.where(simple.to_numpy(zero_copy_only=False), 0, 1)
        rest = words.filter(pc.invert(simple)).to_pylist()
        self._judge("".join(rest))
        kind[kind > 0] = whole = np.array([2 if "<|" in w or not self.odd.isdisjoint(w)
                                           or not unicodedata.is_normalized("NFC", w) else 1 for w in rest], int)
        ids, n = _joined([self._ascii(words.filter(simple)), self._other([w for w, k in zip(rest, whole) if k == 1]),
                          self._whole([w for w, k in zip(rest, whole) if k == 2])])
        place = np.empty(len(words), np.int64)
        place[np.argsort(kind, kind="stable")] = np.arange(len(words))
        return _gather(ids, n, place)


_ENCODERS: dict[int, _Encoder] = {}


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``TASK_ROWS`` rows, and of not much more text than ``TASK_BYTES`` or one row."""
    for part in slices(batches, TASK_ROWS):
        size = pc.binary_length(part.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // TASK_BYTES)) + 1).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a)


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end: int = 0,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents as ids with ``end`` after them,
    those over ``capacity`` cut into pieces of that length."""
    # The vocabulary goes along once per executor; its size does not depend on the data.
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_text())
    key = zlib.crc32(definition.value.encode())
    closing = np.uint32(end)
    schema = (f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece int, start bigint, length bigint, "
              "ids_crc32 bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:
            _ENCODERS[key] = _Encoder(definition.value)
        encode = _ENCODERS[key]
        try:
            yield from encoded(encode, batches)
        finally:
            encode.forget()

    def encoded(encode: _Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _portions(batches):
            ids, sizes = encode(part.column(1).cast(pa.string()))
            ids, sizes = np.insert(ids, np.cumsum(sizes), closing), sizes + 1
            number = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            first = (np.cumsum(sizes) - sizes)[row] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(first.tolist(), (first + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    Each document is its token ids and then ``end``; only longer ones than ``capacity`` are
    cut. Pieces of a sequence lie gapless from 0 and no sequence exceeds ``capacity``.

    A null or empty text is the piece ``end``. Null and repeated ids are rows like others.
    Pieces of equal length are ranked by id, piece and checksum; exact repeats among them are
    interchangeable. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer_file, capacity, end), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan, _ = best_two_fit(counts, capacity)
    shared = spark.sparkContext.broadcast(plan)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(shuffle_width(spark), 8)))
    salted = pieces.withColumn("salt", salt)
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "salt").count()
             .select("length", "salt", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("base")))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("own", F.row_number().over(own) - 1).join(bases, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, each, sequence, offset = shared.value.T
        order = size * 2**46 + first
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = np.searchsorted(order, length * 2**46 + rank, side="right") - 1
            step = rank - first[row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[row] + step // each[row], pa.int64()),
                 pa.array(offset[row] + step % each[row] * length, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")
