import math

import pytest
from pyspark.sql import functions as F

from millrace.functions.signals import normalize_code
from millrace.operators import cleaning, features

NAN = float("nan")


def values(df, column):
    return [r[column] for r in df.collect()]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["  Log Time ", "TBL_Speed"])
    clean = cleaning.normalize_columns(df)
    assert clean.columns == ["log time", "tbl_speed"]
    assert cleaning.find_column(clean, "time", "date") == "log time"
    assert cleaning.find_column(clean, "code") is None


def test_timestamps_that_do_not_parse_are_dropped(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",), (None,), ("2024-01-01T10:00:01Z",)],
                               ["time"])
    parsed = cleaning.parse_timestamp(df, "time")
    assert parsed.columns == ["timestamp"]
    assert sorted(values(parsed.select(F.unix_timestamp("timestamp").alias("s")), "s")) == [
        1704103200, 1704103201]
    same = cleaning.parse_timestamp(df.toDF("timestamp"), "timestamp")
    assert same.columns == ["timestamp"] and same.count() == 2


def test_casts(spark):
    df = spark.createDataFrame([("1.5", "x"), ("n/a", "y"), (None, "z")], ["a", "b"])
    assert values(cleaning.cast_columns(df, ["a", "missing"]), "a") == [1.5, None, None]
    assert values(cleaning.coerce_and_drop(df, ["a"]), "a") == [1.5]


def test_clip_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 5.0), (3, 0.5), (4, None), (5, NAN)], ["i", "x"])
    kept = values(cleaning.clip_outliers(df, "x", 0.0, 1.0).orderBy("i"), "x")
    assert kept[:4] == [0.0, 1.0, 0.5, None] and math.isnan(kept[4])
    assert values(cleaning.clip_outliers(df, "x", 0.0, 1.0, nan="upper").orderBy("i"), "x")[4] == 1.0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 3), (1, "b", 2), (2, "c", 1)], ["k", "s", "o"])
    assert cleaning.drop_duplicates(df).count() == 3
    assert cleaning.drop_duplicates(df, ["k"]).count() == 2
    kept = cleaning.drop_duplicates(df.repartition(3), ["k"], ["o"]).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [(1, "b", 2), (2, "c", 1)]


@pytest.mark.parametrize("strategy, fill", [("zero", 0.0), ("mean", 7 / 3), ("median", 2.0)])
def test_impute(spark, strategy, fill):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, NAN), (4, 2.0), (5, 4.0)], "i int, x double")
    filled = values(cleaning.impute_missing(df, ["x", "nope"], strategy).orderBy("i"), "x")
    assert filled == pytest.approx([1.0, fill, fill, 2.0, 4.0])


def test_impute_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert values(cleaning.impute_missing(df, ["x"], "median"), "x") == [None, None]
    assert cleaning.impute_missing(df, ["other"], "mean") is df
    with pytest.raises(ValueError):
        cleaning.impute_missing(df, ["x"], "mode")


def test_median_of_two(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert 2.0 in values(cleaning.impute_missing(df, ["x"], "median"), "x")


def test_silence(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (NAN,), (3.0,)], "speed double")
    assert values(cleaning.drop_silence(df, "speed"), "speed") == [3.0]


def test_extensions(spark):
    df = spark.createDataFrame([("A.CSV",), ("b.zip",), ("c.txt",), (None,)], ["path"])
    assert sorted(values(cleaning.filter_extension(df, "path", [".csv", ".zip"]), "path")) == ["A.CSV", "b.zip"]


def test_mixed_times(spark):
    df = spark.createDataFrame([("a", "10:00 pm"), ("a", "11:00"), ("b", "11:00"), ("b", None)], ["g", "t"])
    found = {r.g: r.m for r in df.groupBy("g").agg(cleaning.has_mixed_time_format("t").alias("m")).collect()}
    assert found == {"a": True, "b": False}


def test_quarantine_takes_unknown_verdicts(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    good, bad = cleaning.split_valid(df, F.col("x") > 0)
    assert (good.count(), bad.count()) == (1, 2)


def test_codes_and_lookup(spark):
    dim = spark.createDataFrame([("5", 7.0)], "product_code string, diameter double")
    df = spark.createDataFrame([("5",), ("5.0",), ("9",), (None,)], "code string")
    got = {r.code: r.diameter for r in features.enrich_dimension(df, dim, "code").collect()}
    assert got == {"5": 7.0, "5.0": 7.0, "9": None, None: None}
    number = spark.createDataFrame([(5.0,)], "code double")
    assert number.select(normalize_code(F.col("code"))).first()[0] == "5"
    assert features.any_null(features.enrich_dimension(df, dim, "code"), "diameter").first()[0]


def test_strength_and_diameter_are_inverse(spark):
    df = spark.createDataFrame([(10.0, 8.0, 3.0), (10.0, 8.0, 0.0), (1.0, None, 2.0)],
                               "main_comp double, diameter double, cyl_main double")
    strong = features.with_tensile_strength(df).orderBy(F.desc("main_comp")).collect()
    assert len(strong) == 2 and strong[1].dynamic_tensile_strength is None
    assert strong[0].dynamic_tensile_strength == pytest.approx(20000 / (math.pi * 24))
    lab = spark.createDataFrame([("5.0", "100", "2", "3"), ("5", "100", "2", "3"), ("6", "x", "2", "3"),
                                 ("7", "1", "0", "3")],
                                ["code", "tbl_av_hardness", "tbl_tensile", "tbl_max_thickness"])
    found = [tuple(r) for r in features.recover_diameters(lab).collect()]
    assert found == [("5", round(200 / (math.pi * 6), 2))]


def test_feature_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["timestamp", "a", "z"])
    assert features.select_features(df, ["a"]).columns == ["timestamp", "a"]
    with pytest.raises(ValueError, match="b"):
        features.select_features(df, ["a", "b"])


def test_vectors_skip_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (NAN, 1.0)], "a double, b double")
    assert features.assemble_vectors(df, ["a", "b"]).count() == 1


def test_golden(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], ["i", "batch"])
    lab = spark.createDataFrame([("a", 80.0), ("b", 79.9), ("d", 99.0)], ["batch", "dissolution_av"])
    assert values(features.golden_batches(rows, lab, "batch"), "i") == [1]
    assert sorted(values(features.rejected_batches(rows, lab, "batch"), "i")) == [2, 3]


def test_union(spark):
    a = spark.createDataFrame([(1, "x")], ["i", "s"])
    b = spark.createDataFrame([("y",)], ["s"])
    assert sorted(map(tuple, features.union_by_name(a, b).collect()), key=repr) == [(1, "x"), (None, "y")]
