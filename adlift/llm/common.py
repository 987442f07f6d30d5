"""Helpers the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.session import checkpoint_dir


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage the way ``checkpoint()`` does, but as columnar files: later
    plans prune columns, see the size, and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """:func:`save` in buckets of ``column``, as many as a shuffle has partitions: joining or
    grouping by it then moves none of these rows. Only the files stay; the table's name, by
    which Spark knows of the buckets, is dropped again."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    saved = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return saved


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back as soon as it is written, not when the
    driver next collects its garbage. Only for frames that run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(value: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` for a pandas function. The id travels as text: beside a null, pandas
    would turn whole numbers into floats. :func:`id_as_long` turns it back."""
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def id_as_long(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))
