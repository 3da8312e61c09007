"""WARC: round trip, revisits, equal bytes however rows are dealt out."""

import base64
import gzip
import hashlib
import os
import random

import pytest

from millrace.llm.warc import _member, _members, read_archives, write_archives

SCHEMA = "page_id bigint, url string, html string, key int, kind int, refers int, shard int, payload int"


def pages():
    r = random.Random(3)
    bodies = ["<p>a</p>", "", "é" * 50, "x" * 200_000, "<p>\r\n\r\nb</p>", None]
    out = [(i, r.choice([None, f"http://h/{i}", "http://h/a b\r\nc"]), r.choice(bodies) if i % 3 else f"<p>{i}</p>")
           for i in r.sample(range(10**6), 300)]
    return out + [(None, "u", "<p>a</p>"), (None, "u", "alone"), (None, None, "alone")]


def table(spark, rows, parts):
    return spark.createDataFrame([(*p, 1, 2, 3, 4, 5) for p in rows], SCHEMA).repartition(parts)


def by_force(rows, least):
    top = {}
    for page_id, _, body in rows:
        if page_id is not None:
            top[body or ""] = max(page_id, top.get(body or "", page_id))
    out = []
    for page_id, url, body in rows:
        data = (body or "").encode()
        first = top.get(body or "", page_id) if len(data) >= least else page_id
        url = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        out.append((page_id, url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if first == page_id else "revisit", None if first == page_id else first))
    return sorted(out, key=repr)


def files(folder):
    return {f: open(f"{folder}/{f}", "rb").read() for f in sorted(os.listdir(folder)) if f.endswith(".gz")}


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, tmp_path, least):
    rows = pages()
    folder = f"{tmp_path}/one"
    manifest = write_archives(table(spark, rows, 3), folder, shard_bytes=1 << 20, roll_bytes=1500, least=least).collect()
    got = sorted((tuple(x) for x in read_archives(spark, folder).collect()), key=repr)
    assert got == by_force(rows, least)
    found = files(folder)
    assert {m["file"]: (m["bytes"], m["sha256"]) for m in manifest} == {
        f: (len(b), hashlib.sha256(b).hexdigest()) for f, b in found.items()}
    assert sum(m["records"] for m in manifest) == len(rows)
    assert len({f.split("-")[0] for f in found}) > 3 and any("-00001" in f for f in found)
    # Records are in order of ids over the sorted file names, and every file is plain gzip.
    order = [int(line.split(b": ")[1]) for b in found.values() for line in gzip.decompress(b).split(b"\r\n")
             if line.startswith(b"X-Page-ID")]
    assert order == sorted(order)
    again = f"{tmp_path}/two"
    write_archives(table(spark, rows[::-1], 11), again, shard_bytes=1 << 20, roll_bytes=1500, least=least)
    assert files(again) == found


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    folder = f"{tmp_path}/w"
    write_archives(table(spark, [(1, "u", "x")], 1), folder)
    with open(f"{folder}/999999-00000.warc.gz", "wb") as f:
        f.write(b"left by an attempt that was lost")
    assert read_archives(spark, folder).count() == 1


def test_a_missing_or_changed_archive_raises(spark, tmp_path):
    folder = f"{tmp_path}/w"
    write_archives(table(spark, pages(), 2), folder, shard_bytes=1 << 20, roll_bytes=1500)
    some = sorted(files(folder))[1]
    whole = open(f"{folder}/{some}", "rb").read()
    with open(f"{folder}/{some}", "wb") as f:
        f.write(whole + _member(b"WARC/1.1\r\n\r\n"))
    with pytest.raises(Exception, match="other bytes"):
        read_archives(spark, folder).collect()
    os.remove(f"{folder}/{some}")
    with pytest.raises(FileNotFoundError, match=some):
        read_archives(spark, folder)


def test_members_of_any_length():
    r = random.Random(5)
    bodies = [r.randbytes(n) for n in (0, 1, 100_000, 16_384, 7, 300)] + [b"x" * 10**6] + [b"small"] * 20_000
    data = b"".join(map(_member, bodies))
    assert list(_members(data)) == bodies
    with pytest.raises(ValueError):
        list(_members(data[:-1]))


def test_empty_table(spark, tmp_path):
    folder = f"{tmp_path}/e"
    assert write_archives(table(spark, [], 1), folder).collect() == []
    assert read_archives(spark, folder).collect() == []
