"""Results must not depend on how a table is cut into chunks or partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.ordered import CHUNK, POSITION, cut, positions, previous, running_sum
from millrace.operators.quantiles import group_quantiles, quantiles
from millrace.operators.sampling import sample_n
from millrace.operators.sequences import keys_at_ranks

SIZES = [10**6, 150, 40, 7]


@pytest.fixture(scope="module")
def table():
    """One series holds a third of the rows, another has many equal times."""
    rng = np.random.default_rng(3)
    hot = pd.DataFrame({"s": "hot", "t": rng.permutation(300)})
    tied = pd.DataFrame({"s": "tied", "t": rng.integers(0, 3, 200)})
    rest = pd.DataFrame({"s": rng.choice(list("abcdefgh"), 400), "t": rng.integers(0, 90, 400)})
    pdf = pd.concat([hot, tied, rest], ignore_index=True)
    pdf["id"] = rng.permutation(len(pdf))
    pdf["v"] = rng.integers(0, 9, len(pdf))
    return pdf


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("by", [(), ("s",)])
def test_positions_sums_and_previous(spark, table, size, by):
    chunks = cut(spark.createDataFrame(table).repartition(5), by, ["t", "id"], size)
    rows = previous(chunks, positions(chunks, chunks.df), "t", "before")
    got = running_sum(chunks, rows, F.col("v"), "total").toPandas().sort_values([*by, "t", "id"])
    want = table.sort_values([*by, "t", "id"])
    groups = want.groupby(list(by)) if by else want.groupby(lambda _: 0)
    assert (got["id"].to_numpy() == want["id"].to_numpy()).all()
    assert (got[POSITION].to_numpy() == groups.cumcount().to_numpy() + 1).all()
    assert (got["total"].to_numpy() == groups["v"].cumsum().to_numpy()).all()
    np.testing.assert_array_equal(got["before"].astype(float), groups["t"].shift().to_numpy())


def test_hot_series_is_cut_and_others_are_not(spark, table):
    chunks = cut(spark.createDataFrame(table), ["s"], ["t", "id"], 60)
    sizes = chunks.df.groupBy("s", CHUNK).count().toPandas()
    assert chunks.split
    assert sizes.loc[sizes.s == "hot", "count"].max() < 200
    assert (sizes[~sizes.s.isin(["hot", "tied"])].groupby("s").size() == 1).all()


@pytest.mark.parametrize("size", [10**6, 30])
def test_keys_with_nulls_and_two_columns(spark, size):
    pdf = pd.DataFrame({"a": [None, "x", "x", "y"] * 40, "b": [1, 2, None, 4] * 40, "t": range(160)})
    chunks = cut(spark.createDataFrame(pdf), ["a", "b"], ["t"], size)
    got = positions(chunks, chunks.df).orderBy("t").toPandas()
    want = pdf.groupby(["a", "b"], dropna=False).cumcount() + 1
    assert (got[POSITION].to_numpy() == want.to_numpy()).all()


def test_keys_at_ranks(spark, table):
    ordered = sorted(zip(table["t"], table["id"]))
    df = spark.createDataFrame(table)
    for size in (10**6, 25):
        found = keys_at_ranks(df, ["t", "id"], [1, 450, 451, 900], size)
        assert found == {r: ordered[r - 1] for r in (1, 450, 451, 900)}


@pytest.mark.parametrize("size", [10**6, 60, 5])
def test_quantiles_match_numpy(spark, size):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": ["hot"] * 500 + ["b"] * 50 + ["c"], "x": np.round(rng.normal(size=551), 1)})
    pdf.loc[pdf.index[:150], "x"] = 0.5      # a value that holds a third of a group
    pdf.loc[3, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.col("x") != 0.7, F.col("x")))
    pdf.loc[pdf.x == 0.7, "x"] = np.nan
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    np.testing.assert_allclose(quantiles(df, "x", probs, size),
                               np.quantile(pdf.x.dropna(), probs), rtol=1e-12)
    for row in group_quantiles(df, "x", probs, ["g"], size).collect():
        values = pdf[pdf.g == row.g].x.dropna()
        assert row.n == len(values)
        np.testing.assert_allclose(row.quantiles, np.quantile(values, probs), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert quantiles(empty, "x", [0.5]) == [None]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = {r.k for r in sample_n(df, 700, ["k"]).collect()}
    again = {r.k for r in sample_n(df.repartition(7), 700, ["k"]).collect()}
    fast = {r.k for r in sample_n(df, 700, ["k"], portable=False).collect()}
    assert len(first) == 700 and first == again and len(fast) == 700
    assert first != {r.k for r in sample_n(df, 700, ["k"], seed=43).collect()}
    assert sample_n(df, 9000, ["k"]).count() == 5000


@pytest.mark.parametrize("kind", ["double", "string", "date", "timestamp", "timestamp_ntz", "decimal(12,3)", "binary"])
def test_chunks_follow_any_order_type(spark, kind):
    days = (F.col("id") * 37) % 400
    value = {"double": days / 7, "string": F.format_string("k%04d", days), "decimal(12,3)": days / 7,
             "date": F.date_add(F.lit("2024-01-01").cast("date"), days.cast("int")),
             "binary": F.format_string("k%04d", days)}.get(kind, F.timestamp_seconds(days * 7001))
    rows = spark.range(400).withColumn("o", F.when(F.col("id") != 5, value).cast(kind))
    if kind == "double":
        rows = rows.withColumn("o", F.when(F.col("id") == 9, F.lit(float("nan"))).otherwise(F.col("o")))
    whole, parts = cut(rows, (), ["o", "id"], 10**6), cut(rows, (), ["o", "id"], 30)
    assert parts.split
    want = {r.id: r[POSITION] for r in positions(whole, whole.df).collect()}
    assert want == {r.id: r[POSITION] for r in positions(parts, parts.df).collect()}


def test_many_hot_series_keep_the_plan_small(spark):
    """Bounds and keys are tables, not literals: the plan does not grow with the series."""
    sizes = []
    for n in (10, 20_000):
        df = spark.range(n * 6).select((F.col("id") % n).alias("a"), F.lit("x").alias("b"), "id")
        chunks = cut(df, ["a", "b"], ["id"], 4)
        assert chunks.split
        rows = previous(chunks, positions(chunks, chunks.df), "id", "before")
        sizes.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
        assert rows.agg(F.max(POSITION)).first()[0] == 6
    assert sizes[1] < 1.2 * sizes[0]
