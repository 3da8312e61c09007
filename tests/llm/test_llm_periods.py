"""Periodic runs against a search through every start and period."""

import hashlib
import zlib

import numpy as np
import pytest

from millrace.llm.periods import find_runs, gram_hashes, kept_words, periodic_runs, repeat_words, seed_words

SCHEMA = "doc_id bigint, text string, n_runs int, runs string, start string"


def runs_by_force(words, least=24, times=3):
    """Maximal stretches of every period, each under its smallest one."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def report_by_force(doc_id, words):
    runs = runs_by_force(words)
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1] or [(None,) * 3]
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best[0], 1000 * best[0][1] // best[0][2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(), kept)


def nested(block):
    """A period whose grams all occur more than once in it, so none is next to itself one period on."""
    v, w = [f"v{i}" for i in range(block)], [f"w{i}" for i in range(block)]
    return v + v + v + w + v + w + w + w


def random_texts(seed):
    r = np.random.default_rng(seed)
    for _ in range(120):
        words = []
        while len(words) < r.integers(1, 160):
            part = [str(x) for x in r.integers(0, r.integers(1, 6), r.integers(1, 14))]
            words += part * int(r.integers(1, 9)) + part[:int(r.integers(0, len(part)))]
        yield words


CASES = [
    [], ["a"], ["a"] * 23, ["a"] * 24, ["a"] * 500, ["a", "b"] * 11 + ["a", "b"], ["x"] + ["a", "b"] * 30 + ["x"],
    ["a"] * 30 + ["b"] + ["a"] * 30, (["a"] * 25 + ["b"]) * 3, nested(17) * 3, nested(20) * 4 + ["v0"], ["p"] + nested(16) * 3,
    [str(i) for i in range(40)] * 3, [str(i) for i in range(40)] * 3 + ["0"], [str(i) for i in range(40)] * 2,
    (["a"] * 8 + ["b"]) * 20 + ["a"] * 40 + (["a"] * 8 + ["b"]) * 3,
    # A short period after a long one at the same lag, and before it.
    [str(i % 20) for i in range(70)] + ["z"] + [str(i % 5) for i in range(100)],
    [str(i % 5) for i in range(100)] + ["z"] + [str(i % 20) for i in range(70)],
]


def check(words, least=24, times=3):
    ids = np.array([{w: i for i, w in enumerate(dict.fromkeys(words))}[w] for w in words], np.int64)
    k = seed_words(least, times)
    grams = gram_hashes(ids, k) if len(ids) >= k else np.empty(0, np.uint64)
    assert find_runs(ids, grams, least, times) == runs_by_force(words, least, times), words


@pytest.mark.parametrize("words", CASES)
def test_runs_of_given_words(words):
    check(words)


@pytest.mark.parametrize("seed", range(5))
def test_runs_of_random_words(seed):
    for words in random_texts(seed):
        check(words)
        check(words, 12, 2)
        check(words, 30, 4)


def test_the_seed_is_sure():
    assert seed_words(24, 3) == 16 and seed_words(24, 2) == 12 and seed_words(1, 3) == 2


def test_repeats_are_dropped_but_for_the_first_period():
    assert list(kept_words(10, [(2, 6, 2)])) == [0, 1, 2, 3, 8, 9]
    assert list(kept_words(3, [])) == [0, 1, 2]


def test_a_tenth_of_the_documents_is_changed():
    words = [str(i).encode() for i in range(50)]
    changed = [i for i in range(2_000) if repeat_words(words, i) != words]
    assert 150 < len(changed) < 250 and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)
    for i in changed[:50]:
        g = zlib.crc32(str(i).encode()) // 10
        a, p = g % 50, 1 + (50 - g % 50) // (3 + g % 8)
        assert repeat_words(words, i) == [words[j] if j < a else words[a + (j - a) % p] for j in range(50)]
    assert repeat_words(words, None) == words and repeat_words([], changed[0]) == []


def test_reports_equal_brute_force(spark):
    texts = [" ".join(w) for w in CASES] + ["\t\n a\x0b\x0cb\r ", "a b c", None]
    texts += [" ".join(w) for w in list(random_texts(9))[:40]]
    rows = [*enumerate(texts), (None, texts[4]), (4, texts[4]), (99, "y " * 30_000 + "z")]
    df = spark.createDataFrame([(i, t, 1, "r", "s") for i, t in rows], SCHEMA)
    got = periodic_runs(df)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256", "runs", "collapsed"]
    got = [tuple(x) for x in got.drop("runs").collect()]
    words = [[w for w in (t or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ")
              .replace("\x0c", " ").split(" ") if w] for _, t in rows[:-1]]
    expected = [report_by_force(i, w) for (i, _), w in zip(rows, words)]
    expected.append((99, 1, 0, 30_000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(),
                     hashlib.sha256(b"y z").hexdigest(), "y z"))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_runs_are_listed(spark):
    df = spark.createDataFrame([(1, "a " * 30 + "b " * 30, 1, "r", "s")], SCHEMA)
    row = periodic_runs(df, texts=False).collect()[0]
    assert [tuple(x) for x in row["runs"]] == [(0, 30, 1), (30, 30, 1)] and row["collapsed"] is None


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
