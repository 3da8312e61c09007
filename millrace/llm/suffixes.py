"""Removing repeated byte strings by a blockwise suffix sort over a difference cover.

Two suffixes tie if their first ``span`` bytes agree. Sorting all suffixes by ``span`` bytes
is out of reach, but a difference cover (residues modulo v whose differences give every
residue) lets a sample decide most of them: whatever the places i and j, some k < v brings
both i + k and j + k into the sample. So suffixes i and j can only tie if cover samples k
further on agree for at least ``span - v + 1`` bytes.

1. Cover samples are sorted by that many bytes; samples without an equal drop out, and with
   them all suffixes that reach none that is left.
2. Cover samples are sorted by ``v + span`` bytes. Where one has an equal, the suffixes from
   it to v places on are long ties: its rank decides them, and one copy speaks for all.
3. The suffixes still open, and of the long ties the copy that speaks, are sorted by ``span``
   bytes, one bucket of suffixes at a time.

Suffixes stand for themselves as fingerprints of the compared bytes, whose leading bits name
the bucket. A block of documents sends each distinct fingerprint once, so a passage that every
document has costs a bucket one entry for each block. Answers come back as bits, in the order
of the block's sorted fingerprints, and blocks lie in a bucketed table: text is shuffled once.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import mix, written
from millrace.session import scratch_path

BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 1 << 19
#: Places that are worked on at once; longer texts are read in overlapping parts.
PART = 1 << 19

BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache
def difference_cover(q: int) -> np.ndarray:
    """q + 1 residues modulo q*q + q + 1, q prime, whose differences give every residue.

    The zeros of a linear recurrence of order 3 over the field of q elements, for the first
    recurrence of which they are such a set.
    """
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, y, z, zeros = 0, 0, 1, []
                for i in range(v):
                    if x == 0:
                        zeros.append(i)
                    x, y, z = y, z, (a * z + b * y + c * x) % q
                if len(zeros) == q + 1 and len({(s - t) % v for s in zeros for t in zeros}) == v:
                    return np.array(zeros)
    raise ValueError(f"{q} is not prime")


def _cover_for(span: int) -> tuple[np.ndarray, int]:
    """The widest cover that leaves a third of ``span`` to compare, and its modulus."""
    primes = [q for q in range(2, 200) if all(q % d for d in range(2, q))]
    fitting = [q for q in primes if 3 * (q * q + q + 1) <= 2 * span]
    if not fitting:
        raise ValueError("span must be at least 11")
    q = fitting[-1]
    return difference_cover(q), q * q + q + 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random number of each byte; powers of the base and of its inverse modulo 2**64."""
    def run(x: int) -> np.ndarray:
        out = np.full(n, x % 2**64, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return np.random.default_rng(17).integers(0, 2**64, 256, dtype=np.uint64), run(BASE), run(pow(BASE, -1, 2**64))


class _Part:
    """Pieces of texts, one after the other, and fingerprints of strings in them.

    A piece is (text, first byte, own bytes); up to ``overlap`` bytes of its text follow the
    own ones, so that strings that begin in the own bytes can be read.
    """

    def __init__(self, texts: list[bytes], pieces: list[tuple[int, int, int]], overlap: int, sampled: np.ndarray):
        self.pieces = pieces
        data = [texts[i][first:first + own + overlap] for i, first, own in pieces]
        lengths = np.array([len(d) for d in data])
        self.starts = np.cumsum(lengths) - lengths
        self.size = int(lengths.sum())
        self.begin = np.repeat(self.starts.astype(np.int32), lengths)
        self.end = np.repeat((self.starts + lengths).astype(np.int32), lengths)
        place = np.arange(self.size) - self.begin
        self.own = place < np.repeat([own for _, _, own in pieces], lengths)
        place += np.repeat([first for _, first, _ in pieces], lengths)
        self.sample = np.flatnonzero(sampled[place % len(sampled)])
        value, self.up, down = _powers(PART + overlap)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(value[np.frombuffer(b"".join(data), np.uint8)] * down[:self.size], out=self.sums[1:])

    def prints(self, at: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[at + length] - self.sums[at]) * self.up[at])


def _parts(texts: list[bytes], overlap: int, sampled: np.ndarray) -> list[_Part]:
    """Texts in parts of about ``PART`` bytes; one that is longer is cut into overlapping pieces."""
    parts, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        for first in range(0, len(text), PART):
            own = min(PART, len(text) - first)
            more = min(overlap, len(text) - first - own)
            if pieces and size + own + more > PART:
                parts.append(_Part(texts, pieces, overlap, sampled))
                pieces, size = [], 0
            pieces.append((i, first, own))
            size += own + more
    return [*parts, _Part(texts, pieces, overlap, sampled)] if pieces else parts


class _Prints:
    """Sorted distinct fingerprints of a block, cut into buckets of their leading bits."""

    def __init__(self, values: np.ndarray, bits: int, bucket_bits: int):
        self.values, counts = np.unique(values, return_counts=True)
        self.many = counts > 1
        edges = np.arange(1, 2 ** bucket_bits, dtype=np.uint64) << np.uint64(bits - bucket_bits)
        self.cuts = np.concatenate([[0], np.searchsorted(self.values, edges), [len(self.values)]])

    def rows(self, block: int) -> pa.Table:
        pack = zstandard.ZstdCompressor(level=1)
        buckets = np.flatnonzero(np.diff(self.cuts))
        spans = [slice(self.cuts[b], self.cuts[b + 1]) for b in buckets]
        return pa.table({
            "bucket": pa.array(buckets, pa.int32()), "block": pa.array(np.full(len(buckets), block), pa.int32()),
            "prints": pa.array([_shrink(self.values[s], pack) for s in spans], pa.binary()),
            "many": pa.array([np.packbits(self.many[s]).tobytes() for s in spans], pa.binary())})

    def flags(self, answers: pa.Table, name: str) -> np.ndarray:
        out = np.zeros(len(self.values), bool)
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column(name).to_pylist()):
            n = self.cuts[bucket + 1] - self.cuts[bucket]
            out[self.cuts[bucket]:self.cuts[bucket + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        return out

    def ask(self, values: np.ndarray, flags: np.ndarray) -> np.ndarray:
        return flags[np.searchsorted(self.values, values)] if len(values) else np.zeros(0, bool)


def _shrink(values: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Sorted numbers: small steps of the high parts, then the low 16 bits as they are."""
    steps = np.diff(values >> np.uint64(16), prepend=np.uint64(0))
    width = next(w for w in (1, 2, 4, 8) if len(steps) < 2 or int(steps[1:].max()) < 256 ** w)
    head = np.array([len(values), width, steps[0]], "<u8").tobytes()
    return pack.compress(head + steps[1:].astype(f"<u{width}").tobytes()) + (values & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _grow(data: bytes) -> np.ndarray:
    frame = zstandard.ZstdDecompressor().decompressobj()
    body = frame.decompress(data)
    n, width, first = (int(x) for x in np.frombuffer(body[:24], "<u8"))
    steps = np.concatenate([np.array([first], np.uint64), np.frombuffer(body[24:], f"<u{width}").astype(np.uint64)])
    return (np.cumsum(steps, dtype=np.uint64) << np.uint64(16)) + np.frombuffer(data[len(data) - 2 * n:], "<u2")


ROWS = "bucket int, block int, prints binary, many binary"
ANSWERS = "step int, bucket int, block int, repeated binary, speaks binary"


def _sort_bucket(step: int):
    """Sort one bucket of fingerprints: which occur again, and which block has them first."""
    def run(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        prints, many = table.column("prints").to_pylist(), table.column("many").to_pylist()
        lists = [_grow(prints[i]) for i in order]
        ends = np.cumsum([len(x) for x in lists])
        values = np.concatenate(lists)
        again = np.concatenate([np.unpackbits(np.frombuffer(many[i], np.uint8), count=len(x))
                                for i, x in zip(order, lists)]).astype(bool)
        rank = np.argsort(values, kind="stable")
        ranked = values[rank]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        group = np.cumsum(fresh) - 1
        repeated = (np.bincount(group) > 1) | (np.bincount(group, again[rank]) > 0)
        said, first = np.empty(len(values), bool), np.empty(len(values), bool)
        said[rank] = repeated[group]
        first[rank] = fresh  # blocks are in order and the sort is stable
        cut = lambda flags: [np.packbits(x).tobytes() for x in np.split(flags, ends[:-1])]
        n = len(order)
        return pa.table({"step": pa.array([step] * n, pa.int32()),
                         "bucket": pa.array(table.column("bucket").to_pylist(), pa.int32()),
                         "block": pa.array(blocks[order], pa.int32()),
                         "repeated": pa.array(cut(said), pa.binary()), "speaks": pa.array(cut(first), pa.binary())})

    return run


class _Plan:
    """What each step looks at; the same in every pass over a block."""

    def __init__(self, span: int, sample_bits: int, bucket_bits: int):
        self.span, self.sample_bits, self.bucket_bits = span, sample_bits, bucket_bits
        cover, self.v = _cover_for(span)
        self.sampled = np.zeros(self.v, bool)
        self.sampled[cover] = True
        self.short, self.long = span - self.v + 1, self.v + span

    def run(self, texts: list[bytes], answers: pa.Table | None, until: int):
        """Fingerprints that step ``until`` sorts, or after the last step the removed runs.

        Earlier steps are repeated and take their decisions from ``answers``, which is cheaper
        than storing places. What lies in the overlap of a piece is looked up like the rest
        but sent by the piece that owns it.
        """
        parts = _parts(texts, self.v + self.long, self.sampled)
        joined = lambda arrays: np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
        said = lambda step: answers.filter(pc.equal(answers.column("step"), step))

        # 1. Cover samples by their short prefix.
        shift = np.uint64(64 - self.sample_bits)
        shorts = [p.sample[p.sample + self.short <= p.end[p.sample]] for p in parts]
        codes = [p.prints(at, self.short) >> shift for p, at in zip(parts, shorts)]
        prints = _Prints(joined([c[p.own[at]] for p, at, c in zip(parts, shorts, codes)]),
                         self.sample_bits, self.bucket_bits)
        if until == 1:
            return prints
        repeated = prints.flags(said(1), "repeated")
        shorts = [at[prints.ask(c, repeated)] for at, c in zip(shorts, codes)]

        # 2. Those that are left, by their long prefix.
        longs = [at[at + self.long <= p.end[at]] for p, at in zip(parts, shorts)]
        codes = [p.prints(at, self.long) for p, at in zip(parts, longs)]
        prints = _Prints(joined([c[p.own[at]] for p, at, c in zip(parts, longs, codes)]), 64, self.bucket_bits)
        if until == 2:
            return prints
        repeated, speaks = prints.flags(said(2), "repeated"), prints.flags(said(2), "speaks")

        # 3. Suffixes that are neither ruled out nor long ties, and the ties of copies that speak.
        ties, opened = [], []
        for p, at, far, c in zip(parts, shorts, longs, codes):
            again = prints.ask(c, repeated)
            voice = far[again & prints.ask(c, speaks) & p.own[far]]
            far = far[again]
            fits = np.arange(p.size) + self.span <= p.end
            tie = _marked(p.size, far, far + self.v + 1) & fits
            near = _marked(p.size, np.maximum(at - self.v + 1, p.begin[at]), at + 1) & p.own
            ties.append(tie)
            opened.append(np.flatnonzero(((near & ~tie) | _marked(p.size, voice, voice + self.v + 1)) & fits))
        codes = [p.prints(at, self.span) for p, at in zip(parts, opened)]
        prints = _Prints(joined(codes), 64, self.bucket_bits)
        if until == 3:
            return prints
        repeated = prints.flags(said(3), "repeated")

        removed: list[list[tuple[int, int]]] = [[] for _ in texts]
        for p, tie, at, c in zip(parts, ties, opened, codes):
            tie[at[prints.ask(c, repeated)]] = True
            starts = np.flatnonzero(tie)
            covered = _marked(p.size, starts, starts + self.span)
            # Runs end with their piece.
            edge = np.flatnonzero(np.diff(np.where(covered, p.begin + 1, 0), prepend=0, append=0))
            value = np.where(covered, p.begin + 1, 0)
            for low, high in zip(edge.tolist(), edge[1:].tolist()):
                if value[low]:
                    text, first, _ = p.pieces[int(np.searchsorted(p.starts, low, side="right")) - 1]
                    base = first - int(value[low]) + 1
                    removed[text].append((low + base, high + base))
        return removed


def _marked(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places inside any of the half-open ranges."""
    steps = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(np.minimum(ends, n), minlength=n + 1)[:n + 1]
    return np.cumsum(steps)[:n] > 0


def _texts(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("body").to_pylist()]


def remove_repeats(docs: DataFrame, span: int = 200) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` for each row of ``docs``.

    A byte goes if a ``span``-byte string that covers it starts at any other place as well,
    in the same text or another; strings never cross texts, and are judged on the input.
    ``removed`` lists the maximal removed runs (start, end) in bytes.

    A null text is empty, and texts shorter than ``span`` stay whole. Null and repeated ids
    are rows like others, so rows that repeat a text lose it if it has ``span`` bytes. Other
    columns are ignored; an empty table gives no rows. Long texts are taken in parts.

    Strings are told apart by 64-bit fingerprints: with n of them compared, about n * n / 2**65
    pairs are taken for equal by chance (8e-4 for the 1.7e8 of half a gigabyte).
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", body.alias("body"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    blocks = max(16, math.ceil(total / BLOCK_BYTES))
    cover, v = _cover_for(span)
    samples = max(2, total * len(cover) // v)
    bucket_bits = max(4, math.ceil(math.log2(max(2, samples / BUCKET_ENTRIES))))
    sample_bits = min(64, max(bucket_bits + 17, math.ceil(math.log2(samples)) + 11))
    plan = _Plan(span, sample_bits, bucket_bits)
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    (rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "body"), F.lit(blocks)).cast("int"))
     .repartition(blocks, "block").write.bucketBy(blocks, "block").option("compression", "zstd")
     .option("path", scratch_path(spark, "blocks")).saveAsTable(name))
    table = spark.table(name)

    def first_prints(key: tuple, own: pa.Table) -> pa.Table:
        return plan.run(_texts(own), None, 1).rows(key[0].as_py())

    def prints_of(until: int):
        def run(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
            return plan.run(_texts(own), answers, until).rows(key[0].as_py())
        return run

    def spans_of(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _texts(own)
        removed = plan.run(texts, answers, 4)
        runs, digests = [], []
        for text, found in zip(texts, removed):
            merged = _merged(found)
            kept, at = hashlib.sha256(), 0
            for low, high in merged:
                kept.update(text[at:low])
                at = high
            kept.update(text[at:])
            digests.append(kept.hexdigest())
            runs.append([{"start": low, "end": high} for low, high in merged])
        return pa.table({
            "doc_id": own.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([sum(r["end"] - r["start"] for r in x) for x in runs], pa.int64()),
            "n_spans": pa.array([len(x) for x in runs], pa.int64()), "kept_sha256": pa.array(digests, pa.string()),
            "removed": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    answers = None
    for step in (1, 2, 3):
        if answers is None:
            prints = table.groupBy("block").applyInArrow(first_prints, ROWS)
        else:
            prints = table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(prints_of(step), ROWS)
        found = written(prints.groupBy("bucket").applyInArrow(_sort_bucket(step), ANSWERS), "ties")
        answers = found if answers is None else answers.union(found)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        spans_of, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                  "removed array<struct<start: bigint, end: bigint>>")
    out = written(out, "removed")
    spark.sql(f"DROP TABLE {name}")
    return out


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs, which a text read in parts may have, as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(runs):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out
