"""Packing: places, checksums, cuts, and how few sequences."""

import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import _Encoder, best_two_fit, pack

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, rank int, sequence_id int"


def fill(lengths, capacity):
    """Sequences as the plan gives them, piece by piece."""
    plan, n = best_two_fit(dict(Counter(lengths)), capacity)
    seen, sequences = Counter(), defaultdict(list)
    for length in lengths:
        rank, seen[length] = seen[length], seen[length] + 1
        rows = [r for r in plan if r[0] == length and r[1] <= rank]
        _, first, each, sequence, offset = max(rows, key=lambda r: r[1])
        sequences[sequence + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    assert sorted(sequences) == list(range(n))
    return sequences


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_gapless_and_tight(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 50, 128])
    lengths = [min(capacity, 1 + int(r.expovariate(r.choice([0.05, 0.2])))) for _ in range(r.choice([1, 40, 900]))]
    sequences = fill(lengths, capacity)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(lengths) // capacity)
    assert len(sequences) <= max(least + 1, sum(2 * n > capacity for n in lengths), 1.05 * least)


def test_two_documents_replace_the_smallest():
    # Greedily 6 + 3 leaves a gap of 1; 2 + 2 in place of 3 fills the sequence of 10.
    sequences = fill([6, 3, 2, 2], 10)
    assert sorted(n for _, n in sequences[0]) == [2, 2, 6]


def test_pack_whole_texts(spark):
    r = random.Random(1)
    words = ["alpha", "Beta", "naïve", "don't", "x1y22", "<|endoftext|>", "a-b", "日本語", "é", "\x1c", " z"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 60, 700, 5000]))) for _ in range(40)]
    texts += [None, "", " \n", "́combining start", "w" * 5000, texts[3], texts[3]]
    ids = [*range(len(texts) - 2), 3, None]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in zip(ids, texts)], SCHEMA)
    got = pack(df, FILE, capacity=256).collect()
    tokenizer = Tokenizer.from_file(FILE)
    expected = Counter()
    for doc_id, text in zip(ids, texts):
        codes = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(codes), 256)):
            part = codes[at:at + 256]
            expected[doc_id, p, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(x)[:5] for x in got) == expected
    sequences = defaultdict(list)
    for x in got:
        sequences[x["sequence_id"]].append((x["offset"], x["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(k[3] * n for k, n in expected.items())
    assert len(sequences) <= -(-total // 256) + 2


def test_characters_that_the_tokenizer_does_not_split_as_the_pattern(spark):
    texts = ["!\uab6c!", "a\u0558! !\u0558!", "İstanbul ΟΔΟΣ !ΟΔΟΣ! don't", "e\u0301 \u0301x", "x\x1cy\x85z\xa0w"]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)
    codes = [[*c.ids, 0] for c in Tokenizer.from_file(FILE).encode_batch(texts, add_special_tokens=False)]
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in pack(df, FILE).collect()}
    assert got == {i: (len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for i, c in enumerate(codes)}


@pytest.mark.parametrize("pieces", [1, 20, 10_000])
def test_ids_do_not_depend_on_the_table(pieces):
    r, tokenizer = random.Random(pieces), Tokenizer.from_file(FILE)
    encode = _Encoder(Path(FILE).read_text(), pieces)
    letters = ["abcDEF'st", "0123٣²", "!-.,<|>", "éÑßøŽİΣ", "日本語カ", "\x00\x1c\x85\u3000", " \t\n", "e\u0301😀"]
    for _ in range(8):
        texts = ["".join(r.choice(r.choice(letters)) for _ in range(r.choice([0, 1, 9, 90]))) for _ in range(12)]
        ids, sizes = encode(pa.array([*texts, None, "<|endoftext|> a<|startoftext|>"]))
        codes = tokenizer.encode_batch([*texts, "", "<|endoftext|> a<|startoftext|>"], add_special_tokens=False)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [c.ids for c in codes]


def test_a_piece_is_tokenized_once_a_task(monkeypatch):
    encode, asked = _Encoder(Path(FILE).read_text()), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda pieces: asked.extend(pieces) or learn(pieces))
    for texts in (["alpha Alpha, ALPHA! naïve", "beta alpha"], ["(beta) Alpha Naïve", "7beta"]):
        encode(pa.array(texts))
    assert sorted(asked) == sorted(["alpha", ",", "!", "naïve", "beta", "(", ")", "7"])


def test_pack_an_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), FILE).collect() == []
