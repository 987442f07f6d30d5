"""A training-data pipeline: quality rules, exact dedup, SimHash near-dedup, PII, packing.

Each stage calls one operator of ``adlift.llm`` on all that the stage before it kept.
Stages one to four return the columns of ``documents``; packing returns one row per
piece of a packed sequence. ``run`` writes each stage's rows as Parquet to the cluster's
shared folder and rereads them, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlift.llm import queries, simhash, stream_dedup, weak_pii, weak_quality
from adlift.llm.common import save
from adlift.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or are probably bad by all rules' votes, go."""
    return weak_quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return stream_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest id stays."""
    return simhash.keep_one(docs, queries.SHINGLE, queries.DISTANCE)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; every document stays."""
    return weak_pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, one row per piece."""
    return queries.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pii", mask_pii),
    ("packing", pack_sequences),
]

# EM, SimHash over components and tokenizing are not expressible in SQL; tests/llm
# hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
