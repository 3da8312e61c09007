import io
import os
import zipfile
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.plans.layers import gold_job, silver_job
from millrace.session import scratch_path, shared_folder
from millrace.sources import archives, layers
from millrace.sources.delimited import header_groups, read_csv, read_process_csv, role
from millrace.sources.params import load_params, save_params


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def test_columns_are_matched_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", "Time;X;Y\nt1;1;2\n")
    write(tmp_path, "b.csv", " y ;time;x\n20;t2;10\n")
    write(tmp_path, "c.csv", "x;y\n1;2\n")
    write(tmp_path, "d.csv", "\n1;2\n")
    write(tmp_path, "e.csv", "time;x;X\nt;1;2\n")
    rows, rejected = read_process_csv(spark, str(tmp_path), needed=("time",))
    got = [(r[role("time")], r.x, r.y, r.source_file) for r in rows.orderBy(role("time")).collect()]
    assert "time" not in rows.columns
    assert got == [("t1", "1", "2", "a.csv"), ("t2", "10", "20", "b.csv")]
    assert sorted((os.path.basename(r.path), r.reason[:9]) for r in rejected.collect()) == [
        ("c.csv", "no column"), ("d.csv", "no header"), ("e.csv", "repeated ")]


def test_no_files(spark, tmp_path):
    write(tmp_path, "c.csv", "x;y\n1;2\n")
    rows, rejected = read_process_csv(spark, str(tmp_path))
    assert rows is None and rejected.count() == 1


def test_odd_files(spark, tmp_path):
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "with space.csv", "\ufeffDate;Speed\r\nt;1\r\n")
    write(tmp_path, "bad rows.csv", "date;speed\nu;2\nonly one\nv;3;4\nw;5\n")
    rows, rejected = read_process_csv(spark, str(tmp_path))
    assert sorted((r[role("time")], r[role("speed")], r[role("code")]) for r in rows.collect()) == [
        ("t", "1", None), ("u", "2", None), ("w", "5", None)]
    assert sorted((os.path.basename(r.path), r.reason, r.line) for r in rejected.collect()) == [
        ("bad%20rows.csv", "malformed row", "only one"), ("bad%20rows.csv", "malformed row", "v;3;4")]
    assert rows.count() == 3 and rejected.count() == 2


def test_every_layout_keeps_its_rows(spark, tmp_path):
    """Roles are found file by file, and equal names in two folders are two fragments."""
    layouts = [("a/f.csv", "timestamp;tbl_speed;code"), ("b/f.csv", "Date;speed;product"),
               ("c.csv", "code;Speed;log time"), ("d.csv", "product;tbl_speed;date")]
    for name, header in layouts:
        values = {"t": "2024-01-01 00:{:02d}:{:02d}", "s": "4", "p": "5.0"}
        kinds = ["t" if "time" in c.lower() or "date" in c.lower() else "s" if "speed" in c.lower() else "p"
                 for c in header.split(";")]
        lines = [";".join(values[k].format(i // 60, i % 60) for k in kinds) for i in range(300)]
        write(f"{tmp_path}/raw/{os.path.dirname(name)}", os.path.basename(name), header + "\n" + "\n".join(lines) + "\n")
    write(f"{tmp_path}/raw", "e.csv", "time;x\n1;2\n")
    for folder in "xy":  # too short, each on its own
        write(f"{tmp_path}/raw/{folder}", "short.csv", "time;speed\n" + "\n".join(
            f"2024-01-01 00:{i // 60:02d}:{i % 60:02d};1" for i in range(150)) + "\n")
    dim = spark.createDataFrame([("5", 7.0)], "product_code string, diameter double")
    rejected = silver_job(spark, f"{tmp_path}/raw", f"{tmp_path}/silver", dim)
    assert [os.path.basename(r.path) for r in rejected.collect()] == ["e.csv"]
    clean = spark.read.parquet(f"{tmp_path}/silver")
    assert [r["count"] for r in clean.groupBy("source_path").count().collect()] == [210] * 4
    assert [tuple(r) for r in clean.select("diameter").distinct().collect()] == [(7.0,)]


def test_smoke_csv_to_parquet(spark, tmp_path):
    write(tmp_path, "s.csv", "a,b\n1,x\n2,y\n3,z\n")
    df = read_csv(spark, f"{tmp_path}/s.csv")
    layers.write_layer(df, f"{tmp_path}/out")
    assert df.count() == 3 and layers.read_layer(spark, f"{tmp_path}/out", ["b"]).columns == ["b"]


def test_archives(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("Process/", "")
        z.writestr("Process/1.csv", "h\r\n1\r\n2")
        z.writestr("Laboratory.csv", "a;b\n")
    (tmp_path / "x.zip").write_bytes(buffer.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    got = archives.expand_archives(archives.read_archives(spark, str(tmp_path))).collect()
    lines = sorted((r.member, r.line_no, r.line) for r in got if r.member)
    assert lines == [("Laboratory.csv", 0, "a;b"), ("process_time_series/1.csv", 0, "h"),
                     ("process_time_series/1.csv", 1, "1"), ("process_time_series/1.csv", 2, "2")]
    assert [os.path.basename(r.archive) for r in got if r.member is None] == ["bad.zip"]


def test_archives_to_bronze(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in/deep")
    with zipfile.ZipFile(f"{tmp_path}/in/deep/x.ZiP", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("Process/", "")
        z.writestr("Process/a/1.csv", "time;speed\n2024-01-01 00:00:00;1\n")
        z.writestr("Laboratory.csv", b"\xff;b\n")
        z.writestr("Process/2.csv", "x" * 100_000)
    raw = bytearray((tmp_path / "in/deep/x.ZiP").read_bytes())
    raw[raw.rindex(b"Process/2.csv", 0, raw.index(b"PK\x01\x02")) + 20] ^= 0xFF   # a broken member
    (tmp_path / "in/deep/x.ZiP").write_bytes(raw)
    (tmp_path / "in/bad.zip").write_bytes(b"no archive")
    report = archives.archives_to_bronze(spark, f"{tmp_path}/in", f"{tmp_path}/bronze").collect()
    assert {(os.path.basename(r.archive), r.member, r.error is None) for r in report} == {
        ("x.ZiP", "Process/a/1.csv", True), ("x.ZiP", "Laboratory.csv", True), ("x.ZiP", "Process/2.csv", False),
        ("bad.zip", None, False)}
    assert (tmp_path / "bronze/Laboratory.csv").read_bytes() == b"\xff;b\n"
    rows, rejected = read_process_csv(spark, f"{tmp_path}/bronze")
    assert [(r[role("speed")], r.source_file) for r in rows.collect()] == [("1", "1.csv")]
    assert [os.path.basename(r.path) for r in rejected.collect()] == ["Laboratory.csv"]
    lines = archives.expand_archives(archives.read_archives(spark, f"{tmp_path}/in")).collect()
    assert ("Laboratory.csv", None) in {(r.member, r.line) for r in lines}


def test_dimension_and_listing(spark, tmp_path):
    write(tmp_path, "map.json", '{\n "1": 6.07,\n "2": 6\n}')
    got = {r.key: r.value for r in layers.read_dimension_file(spark, f"{tmp_path}/map.json").collect()}
    assert got == {"1": 6.07, "2": 6.0}
    write(f"{tmp_path}/deep", "a.csv", "x")
    assert [os.path.basename(r.path) for r in layers.list_layer(spark, str(tmp_path), ".csv").collect()] == ["a.csv"]
    assert layers.first_existing(spark, [f"{tmp_path}/none", f"{tmp_path}/deep"]).endswith("deep")
    with pytest.raises(FileNotFoundError):
        layers.first_existing(spark, [f"{tmp_path}/none"])
    assert layers.layer_path("GOLD", {"gold": "s3a://g"}) == "s3a://g"
    assert layers.layer_path("other", {"gold": "s3a://g"}) == "other"


def parts_of(spark, path):
    return sorted(((r.f, r.x) for r in spark.read.schema("x int, f string").parquet(path).collect()), key=str)


def test_a_rerun_replaces_its_parts_only(spark, tmp_path):
    path, frame = f"{tmp_path}/out", lambda rows: spark.createDataFrame(rows, "f string, x int")
    layers.replace_parts(frame([("a", 1), ("a", 2), ("b", 3), (None, 4)]), path, ["f"])
    layers.replace_parts(frame([("a", 5), ("c", 6), (None, 7), (None, 8)]), path, ["f"])
    assert parts_of(spark, path) == sorted([("a", 5), ("b", 3), ("c", 6), (None, 7), (None, 8)], key=str)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/f=b/*.parquet")}
    layers.replace_parts(frame([]), path, ["f"])
    layers.replace_parts(frame([("c", 9)]), path, ["f"])
    assert parts_of(spark, path) == sorted([("a", 5), ("b", 3), ("c", 9), (None, 7), (None, 8)], key=str)
    assert before and before == {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/f=b/*.parquet")}
    with pytest.raises(ValueError):
        layers.replace_parts(frame([("c", 9)]), path, [])


def test_a_failed_rerun_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/out"
    layers.replace_parts(spark.createDataFrame([("a", 1), ("b", 2)], "f string, x int"), path, ["f"])
    bad = spark.range(100).select(F.lit("a").alias("f"), F.when(F.col("id") < 99, F.col("id").cast("int"))
                                  .otherwise(F.raise_error(F.lit("lost")).cast("int")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        layers.replace_parts(bad, path, ["f"])
    assert parts_of(spark, path) == [("a", 1), ("b", 2)]


def test_lineage_merges_schemas(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/p/a")
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/p/b")
    df = layers.read_with_lineage(spark, f"{tmp_path}/p")
    assert df.count() == 5 and df.filter("x is null").count() == 2
    assert df.filter("source_file like '%.parquet'").count() == 5


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_reports(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1.5, True)], "s string, x double, b boolean")
    layers.write_report(df, f"{tmp_path}/r", fmt)
    assert layers.read_report(spark, f"{tmp_path}/r", df.schema, fmt).collect() == df.collect()
    with pytest.raises(ValueError):
        layers.write_report(df, f"{tmp_path}/q", "xls")


def test_params(spark, tmp_path):
    arrays = {"v": np.array([1.0, np.inf]), "m": np.arange(6.0).reshape(2, 3)}
    save_params(spark, f"{tmp_path}/m", "x", arrays)
    got = load_params(spark, f"{tmp_path}/m", "x")
    assert set(got) == {"v", "m"} and all((got[k] == arrays[k]).all() for k in arrays)


def session_stub(conf, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
                           sparkContext=SimpleNamespace(master=master, applicationId="stub"))


def test_shared_folder_comes_from_the_session(spark):
    named = session_stub({"spark.checkpoint.dir": "s3a://bucket/tmp/"}, "spark://cluster:7077")
    assert shared_folder(named) == "s3a://bucket/tmp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_stub({}, "yarn"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/millrace-")


def bronze(path, name, n, code, start=0):
    lines = [f"2024-01-01 00:00:00;{code};0;1;1;1;1"]      # silent row
    for i in range(n):
        t = start + 10 * i
        lines.append(f"2024-01-{1 + t // 86400:02d} {t // 3600 % 24:02d}:{t // 60 % 60:02d}:{t % 60:02d};{code};"
                     f"{5 + i % 7};{10 + i % 5};{2 + i % 3};{100 + i % 11};{3 + i % 4}")
    lines.append(f"garbage;{code};1;1;1;1;1")
    write(path, name, "Timestamp;Product_Code;tbl_speed;main_comp;cyl_main;tbl_fill;ejection\n" + "\n".join(lines) + "\n")


def test_raw_files_to_gold(spark, tmp_path):
    raw = f"{tmp_path}/bronze"
    bronze(raw, "a.csv", 300, "5.0")
    bronze(raw, "b.csv", 250, "9", 5000)
    bronze(raw, "c.csv", 150, "5", 9000)       # too short after the warm-up
    write(raw, "d.csv", "x;y\n1;2\n")          # no time column
    dim = spark.createDataFrame([("5", 7.0), ("9", 7.1)], "product_code string, diameter double")
    rejected = silver_job(spark, raw, f"{tmp_path}/silver", dim)
    assert rejected.count() == 1
    clean = spark.read.parquet(f"{tmp_path}/silver")
    assert {r.source_file: r["count"] for r in clean.groupBy("source_file").count().collect()} == {
        "a.csv": 210, "b.csv": 160}
    assert {r.diameter for r in clean.select("diameter").distinct().collect()} == {7.0, 7.1}
    made = gold_job(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", order_by=["timestamp", "source_file"],
                    keep=["timestamp"])
    counts = {r.split: r["count"] for r in made.rows.groupBy("split").count().collect()}
    assert counts == {"train": 259, "val": 55, "test": 56}
    train = made.rows.filter("split = 'train'").agg(*[F.min(c) for c in made.scaler.features],
                                                    *[F.max(c) for c in made.scaler.features]).first()
    assert list(train) == pytest.approx([0.0] * 5 + [1.0] * 5)


def test_headers_of_files_in_blocks(spark, tmp_path):
    """A large file is read block by block, and no line but the first goes to Python."""
    (tmp_path / "long.csv").write_text("time;speed\n" + "2024;1\n" * 3_000)
    (tmp_path / "short.csv").write_text("date;speed\n2024;1\n")
    (tmp_path / "blank.csv").write_text("\n2024;1\n")
    (tmp_path / "empty.csv").write_text("")
    read = type(spark.range(1)).mapInArrow
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        type(spark.range(1)).mapInArrow = None
        found = header_groups(spark, str(tmp_path))
    finally:
        type(spark.range(1)).mapInArrow = read
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(p.rsplit("/", 1)[-1], h) for p, h in found} == {
        ("long.csv", "time;speed"), ("short.csv", "date;speed"), ("blank.csv", None)}
    assert len(found) == 3
