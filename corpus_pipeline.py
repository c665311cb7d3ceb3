"""A training-data pipeline: each stage applies one operator to all documents that the stage before it kept."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rentlens.llm import bpe, mixing, pii, quality, simhash  # noqa: E402
from rentlens.sources.store import Store  # noqa: E402


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model is fitted on labelled documents of ``docs``."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_first(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, replaced by their kind."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; sources below their weight are read again, so no document is lost."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their digests, with the digest of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", reject_low_quality), ("near_duplicates", drop_near_duplicates), ("pii", sanitise),
          ("mixing", mix_sources), ("bpe", encode)]

#: The classifier, the components and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
