"""Spelling variants against a comparison of all words with each other."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import spelling
from millrace.llm.spelling import last_forms, near_words, spelling_forms, word_counts

SCHEMA = "doc_id bigint, text string, word int, n string, form int, tile int"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_by_force(docs, slip_every=None):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if slip_every and doc_id is not None and h % slip_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def forms_by_force(words):
    form, rows = {}, {}
    for w in words:
        near = sorted((x for x in words if one_edit(w, x)), key=lambda x: (-words[x], x))
        form[w] = near[0] if near and words[near[0]] >= 2 * words[w] else None
        rows[w] = (form[w], words[w], len(near), words[near[0]] if form[w] else None)
    out = []
    for w, (f, n, n_near, form_n) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, f, root, n, n_near, form_n))
    return sorted(out, key=repr)


def corpus(seed):
    r = np.random.default_rng(seed)
    letters = list("abcxyzéÿ")
    stems = ["".join(r.choice(letters, r.integers(4, 9))) for _ in range(40)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(80):
            w = list(stems[min(39, int(r.exponential(8)))])
            if r.random() < 0.4:
                at = int(r.integers(0, len(w)))
                w[at:at + 1] = [[], [r.choice(letters)], [w[at], r.choice(letters)]][r.integers(0, 3)]
            words.append("".join(w))
        docs.append((i, " ".join(words).title() if i % 3 else "-".join(words)))
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "n", 2, 3) for i, t in docs], SCHEMA)


ODD = [(None, None), (1, ""), (2, None), (None, "Zebras zebras ZEBRAS zebra zebra zebra"), (3, "ÀÉ×÷ àé×÷ øøøøø øøøøø øøøøø øøøøø1øøøøø"),
       (4, "abcde" * 9_000), (4, "abcde" * 9_000), (5, "abcde" * 9_000), (6, "abcde" * 9_000 + "x " + "abcde" * 9_000 + "y"),
       (6, "abcde" * 9_000 + "x " + "abcde" * 9_000 + "x"), (7, "日本abcdef日 abcdef abcdefİabcdef"),
       (8, "q" * 130 + " " + "q" * 131 + " " + "q" * 129 + "r"), (9, "q" * 130 + " " + "q" * 131 + " " + "q" * 129 + "r"),
       (10, "q" * 130 + " " + "q" * 131 + " " + "q" * 129 + "r" + " q" * 3), (11, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaab aaaaab aaaaab")]


@pytest.mark.parametrize("seed, slip", [(1, None), (2, 7), (3, 97)])
def test_forms_equal_brute_force(spark, monkeypatch, seed, slip):
    monkeypatch.setattr(spelling, "MOST_WORDS", 50)
    docs = corpus(seed) + ODD + ODD[3:5]
    words = words_by_force(docs, slip)
    assert len(words) > 100
    got = spelling_forms(frame(spark, docs), slip_every=slip)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == forms_by_force(words)


def test_counts(spark):
    docs = corpus(5) + ODD
    got = {x["word"]: x["n"] for x in word_counts(frame(spark, docs)).collect()}
    assert got == words_by_force(docs)


@pytest.mark.parametrize("block, rows", [(32, 20_000), (3, 50), (1, 1)])
def test_blocks_and_batches_do_not_matter(block, rows):
    """Tiles that go on over blocks and over batches lose no pair."""
    import pyarrow as pa

    r = np.random.default_rng(0)
    words = sorted({"".join(r.choice(list("ab"), r.integers(5, 8))) for _ in range(90)})
    n = {w: int(r.integers(3, 9)) for w in words}
    listed = []
    for w in words:
        for longer in (len(w), len(w) + 1):
            for at in range(0, longer, 2):
                own = min(2, longer - at)
                rest = longer - at - own
                listed.append((longer, hash((longer, at, w[:at], w[len(w) - rest:])), at, w, n[w], own))
    listed.sort()
    longer, tile, at, word, count, width = zip(*listed)
    table = pa.table({"word": word, "n": pa.array(count, pa.int64()), "longer": pa.array(longer, pa.int32()),
                      "at": pa.array(at, pa.int32()), "width": pa.array(width, pa.int32()), "tile": pa.array(tile, pa.int64())})
    before = spelling.BLOCK, spelling.ROWS
    spelling.BLOCK, spelling.ROWS = block, rows
    try:
        found = [x for b in spelling._compare_tiles(iter(table.to_batches(max_chunksize=7))) for x in b.to_pylist()]
    finally:
        spelling.BLOCK, spelling.ROWS = before
    near = Counter()
    for x in found:
        near[x["word"]] += x["n_near"]
    assert near == Counter({w: c for w in words if (c := sum(one_edit(w, x) for x in words))})


def test_a_tile_with_many_words(spark):
    """All words agree in all but two letters, so one tile holds them all."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xe0, 0x100)]]
    words = [f"pre{a}{b}" for a in letters[:40] for b in letters[:40]]
    df = spark.createDataFrame([(w, 3 + i % 7) for i, w in enumerate(words)], "word string, n bigint")
    got = near_words(df).collect()
    assert len(got) == 1600 and {x["n_near"] for x in got} == {78}


def test_long_chains(spark):
    """Chains of forms end at their last word, whatever their length."""
    names = [f"w{i:03d}" for i in range(70)]
    links = spark.createDataFrame(list(zip(names, names[1:])) + [("side", "w060"), ("other", "last")], "word string, form string")
    got = {x["word"]: x["root"] for x in last_forms(links).collect()}
    assert got == {**{w: "w069" for w in names[:-1]}, "side": "w069", "other": "last"}


def test_empty_table(spark):
    assert spelling_forms(frame(spark, [])).collect() == []
    assert spelling_forms(frame(spark, [(1, None), (2, "a b")])).collect() == []
