"""What a day of an input looked like: a version per day, to tell which days have changed.

Two sources of versions, both a table ``date, version`` of one row per day:

- :func:`content_versions` reads the rows: right for any table, at the cost of a scan.
- :func:`file_versions` lists the day folders of a partitioned table on the driver (names,
  sizes and times of the files, nothing read). It takes the stored day as the row's day,
  which holds for sales in the ``parts`` form and for placements stored by their begin day.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "date date, version string"


def content_versions(df: DataFrame, day: str = "date") -> DataFrame:
    """Per day, a hash of its rows as a multiset: their number and the sum of their hashes.

    Sums commute, so the order and the partitioning of the rows do not matter, and a
    repeated row counts. Rows without a day have no version.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    per_day = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row).alias("h"))
    return per_day.select("date", F.concat_ws(":", F.col("n").cast("string"), F.col("h").cast("string")).alias("version"))


def file_versions(spark: SparkSession, root: str, days: list[dt.date], parts: tuple[str, str, str] = ("year", "month", "day")) -> DataFrame:
    """Per day that has a folder, a hash of its files' names, sizes and times (one listing per day)."""
    jvm, out = spark._jvm, []
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    fs = path(".").getFileSystem(spark._jsc.hadoopConfiguration())
    y, m, d = parts
    for day in days:
        seen = []
        # Partition values may be padded or not.
        for mm in {str(day.month), f"{day.month:02d}"}:
            for dd in {str(day.day), f"{day.day:02d}"}:
                at = path(f"{y}={day.year}/{m}={mm}/{d}={dd}")
                if fs.exists(at):
                    seen += [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at)]
        if seen:
            out.append((day, hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()))
    return spark.createDataFrame(out, VERSIONS)


def combined(*versions: DataFrame) -> DataFrame:
    """One version per day from several inputs' versions, each told apart by its place."""
    every = None
    for i, v in enumerate(versions):
        own = v.select("date", F.lit(i).alias("i"), "version")
        every = own if every is None else every.unionByName(own)
    return every.groupBy("date").agg(F.sort_array(F.collect_list(F.struct("i", "version"))).alias("v")).select(
        "date", F.sha2(F.col("v").cast("string"), 256).alias("version"))
