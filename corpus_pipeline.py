"""Corpus pipeline over ``documents``: language identification, near duplicates,
benchmark decontamination, pseudonyms, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage's rows are written
as Parquet in the shared work folder and read again as the next stage's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.llm.common import SMALL_BATCH_BYTES, bound_batches, materialise, table
from framewell.llm.decontaminate import drop_contaminated
from framewell.llm.lang_id import keep_identified
from framewell.llm.mixing import with_rates
from framewell.llm.ngram_join import keep_first
from framewell.llm.pseudonyms import with_pseudonyms


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go."""
    bound_batches(spark, SMALL_BATCH_BYTES)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays."""
    bound_batches(spark, SMALL_BATCH_BYTES)
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    benchmark = table(spark, sf_dir, "benchmark")
    bound_batches(spark, SMALL_BATCH_BYTES)
    return drop_contaminated(docs, benchmark)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data get pseudonyms; no document goes."""
    bound_batches(spark, SMALL_BATCH_BYTES)
    return with_pseudonyms(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates and copies that bring quality classes to their target shares; rows of no copy go."""
    return with_rates(docs, table(spark, sf_dir, "labels"))


STAGES = [("language_id", language_id), ("ngram_join", near_duplicates), ("decontaminate", decontamination),
          ("pseudonyms", pseudonyms), ("mixing", mixing)]

# Hashing, models and keyed permutations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
