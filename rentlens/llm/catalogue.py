"""Queries of the subpackage, each on its whole table with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rentlens.llm import (align, bpe, chunks, language, main_text, mixing, neighbours, pii, quality, runs, simhash, sketch,
                          token_cache)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(_table(spark, folder, "pages"))


def op3_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeats(_table(spark, folder, "documents"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprints(_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_cache.token_counts(_table(spark, folder, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule(_table(spark, folder, "documents").select("doc_id", "source"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(_table(spark, folder, "embeddings"))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.detect(runs.with_planted(_table(spark, folder, "documents"))))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_bpe, op2_main_text, op3_chunks, op4_fingerprints, op5_token_counts, op6_simhash, op7_mixing, op8_quality,
    op9_pii, op10_neighbours, op11_runs, op12_alignment, op13_language)}
ORACLES: dict[str, str] = {}
