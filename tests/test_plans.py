"""Physical plans: what is shuffled, sorted and read."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, features, sequences, windows
from millrace.operators.detect import pca
from millrace.queries.cleaning import purge
from millrace.queries.registry import FRAGMENT, ORDER, SIGNAL_ORDER, SPEED, signals, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return len(re.findall(rf"[-+ ]{name}\b", plan(df)))


@pytest.fixture(scope="module")
def process(spark, small):
    return table(spark, small, "lineitem").select(*FRAGMENT, *ORDER, SPEED, "l_tax")


def test_warmup_shuffles_and_sorts_once(process):
    kept = sequences.trim_warmup(cleaning.drop_silence(process, SPEED), FRAGMENT, ORDER, 90, 100)
    assert nodes(kept, "Exchange") == 1 and nodes(kept, "Sort") == 1
    assert "GreaterThan(l_discount,0.0)" in plan(kept)


@pytest.mark.parametrize("build", [
    lambda df: windows.freeze_flag(df, ["user_id"], SIGNAL_ORDER, ["value", "k"], 5),
    lambda df: windows.sliding_windows(df, ["user_id"], SIGNAL_ORDER, ["value", "k"], 5),
    lambda df: windows.padded_windows(df, ["user_id"], SIGNAL_ORDER, ["value"], 5),
    lambda df: windows.map_windows(df, ["user_id"], SIGNAL_ORDER, ["value"], 5,
                                   lambda w: {"m": w[:, 0, 0]}, "m double"),
])
def test_windows_shuffle_and_sort_once(spark, small, build):
    made = build(signals(spark, small))
    assert nodes(made, "Exchange") == 1 and nodes(made, "Sort") == 1


@pytest.mark.parametrize("build", [
    lambda df: sequences.split_sequences_by_gap(df, "ts", 600, ["event_id"], rows_per_task=200),
    lambda df: sequences.chronological_split(df, SIGNAL_ORDER, rows_per_task=200),
    lambda df: windows.sliding_windows(df, [], SIGNAL_ORDER, ["value"], 5, rows_per_task=200),
])
def test_a_long_table_never_meets_in_one_task(spark, small, build):
    text = plan(build(signals(spark, small)))
    # Only carry tables, which are aggregated to a row per chunk first, may be folded in one task.
    for at in re.finditer("SinglePartition", text):
        assert "HashAggregate" in text[at.end():at.end() + 400]


def test_time_split_moves_no_rows(spark, small):
    assert nodes(sequences.chronological_split(signals(spark, small), SIGNAL_ORDER), "Exchange") == 0


def test_scoring_expressions_stay_in_the_scan_stage(process):
    model = pca.pca_fit(process, [SPEED, "l_tax"], 1)
    scored = process.select(model.error().alias("e"), pca.mahalanobis(pca.fit_moments(process, [SPEED, "l_tax"])))
    assert nodes(scored, "Exchange") == 0 and "Python" not in plan(scored)
    assert "ReadSchema: struct<l_discount:double,l_tax:double>" in plan(scored)


def test_fixed_dimension_is_broadcast(spark, process):
    dim = spark.createDataFrame(list(features.PRODUCT_DIAMETERS.items()), "product_code string, diameter double")
    joined = features.enrich_dimension(process.withColumn("code", F.col("l_linenumber")), dim, "code")
    assert "BroadcastHashJoin" in plan(joined)


def test_flagship_reads_only_its_columns(spark, small):
    text = plan(purge(spark, small))
    assert "l_linestatus" not in text and "p_name" not in text


def test_no_plan_has_a_cross_join(spark, small):
    from millrace.queries import QUERIES
    for name in ("scenario_grid", "inject_rows", "minmax_scale", "histogram", "row_sensitivity_pca"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, small))
        assert "NestedLoop" not in plan(QUERIES[name](spark, small))
