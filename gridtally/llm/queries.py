"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm import (
    decontamination, language_id, lexical_search, line_dedup, lm_scoring, oracles, packing, quality_rules, sharding,
    simhash, suffix_dedup, surrogates, token_counts, whitening,
)
from workload.registry import query

#: Key of the surrogates; set it to a secret where the result leaves the house.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "registered-query")

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
BENCHMARK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
EMBEDDINGS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(BENCHMARK).parquet(f"{sf_dir}/benchmark.parquet")


def byte_vocabulary(path: str | None = None) -> str:
    """The vocabulary file's text; the driver reads it and sends it on."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


@query("op2_quality_rules", oracles.QUALITY_RULES)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in one of eight shards of nearly equal bytes."""
    return sharding.shard(documents(spark, sf_dir), shards=8)


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece length of every document under the 32,000-piece vocabulary."""
    pieces = token_counts.sentencepiece_vocabulary(str(public_tokenizers.path("piece_bpe_32k.model")))
    return token_counts.count_tokens(documents(spark, sf_dir), pieces)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    return language_id.identify_held_out(documents(spark, sf_dir))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    return packing.pack(documents(spark, sf_dir), byte_vocabulary(), capacity=1024)


@query("op9_decontamination", oracles.DECONTAMINATION)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return decontamination.find(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query("op4_line_dedup", oracles.LINE_DEDUP)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without later copies of line runs of 50 words."""
    return line_dedup.summary(documents(spark, sf_dir))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of smaller documents."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), with_bytes=False)


@query("op7_surrogates")
def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return surrogates.summary(documents(spark, sf_dir), key=SURROGATE_KEY)


@query("op11_lexical_search", oracles.LEXICAL_SEARCH)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir), k=20)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four main axes, whitened."""
    return whitening.whiten(spark.read.schema(EMBEDDINGS).parquet(f"{sf_dir}/embeddings.parquet"), components=4)


@query("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a model of four fifths of them."""
    return lm_scoring.score_held_out(documents(spark, sf_dir), order=2)
