"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before has written, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import decontamination, line_dedup, packing, quality_rules, queries, simhash
from gridtally.session import saved
from workload.registry import query

CAPACITY = 1024


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and every rule of the table."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that held nothing else goes."""
    out = line_dedup.dedup(docs)
    out = out.filter((F.col("n_removed") == 0) | F.col("kept").rlike(quality_rules.NOT_WHITE))
    changed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.keep_clean(docs, queries.benchmark(spark, sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most CAPACITY tokens."""
    return packing.pack(docs, queries.byte_vocabulary(), CAPACITY)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", pack),
]

#: Components and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
