"""The corpus pipeline: filter, deduplicate, redact, mix and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. A stage's result is written as Parquet and read as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import bounded_batches, written
from millrace.llm.minmax import first_of_groups
from millrace.llm.mixing import mix
from millrace.llm.packing import pack
from millrace.llm.queries import source_domain
from millrace.llm.secret_scan import redact_secrets
from millrace.llm.toxicity import fit_chain, rate, toxicity_categories
from millrace.session import prepare

NEAR_PERCENT = 80
# Languages by weight within a domain, sources alike; nothing is repeated.
WEIGHTS = {"domain": {"web": 4, "reference": 3, "forum": 3}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}
PERCENT, SEED = 90, 42
CAPACITY = 2048


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go."""
    bounded_batches(prepare(spark))
    chain = fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity_categories())
    return rate(docs, chain).where("not ratings.is_toxic").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    bounded_batches(prepare(spark))
    return first_of_groups(docs, percent=NEAR_PERCENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text. Null and empty texts stay as they are, and so does every row."""
    return redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut to their target weights; tokens that a long document leaves go to other sources.

    Null sources and languages are leaves of their own; documents without words cost nothing.
    """
    drawn = mix(docs, WEIGHTS, source_domain(), percent=PERCENT, epochs=1, seed=SEED)
    return drawn.select(*[f"row.`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of ``CAPACITY`` tokens; a null text is an empty one."""
    bounded_batches(prepare(spark))
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secrets", secrets), ("source_mix", source_mix),
          ("packing", packing)]

# The chain's training, the tokenizer and the fill have no SQL form; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
