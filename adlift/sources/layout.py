"""Facts laid out for the job: bucketed by (date, sku, location_id) within their day.

Written once, by whoever lands the facts, as two catalog tables: normalised sales, and
placements exploded to one row per tracked SKU. Every join and every per-key step of the
attribution and of the anti-join is on these three columns, so a scan's buckets are the
partitioning all of them need: no shuffle between a scan and those joins, in any run.

A bucket holds its keys of all days read, and a task reads one bucket, so the number of
buckets is the parallelism of the run, chosen at the write. A hot (day, SKU, location) stays
in its bucket: the placement side has one row of it there, and its lines are sorted on
disk, not held. Where a key may outgrow a task, use the plain layout, whose joins adaptive
execution can split (``attribution.attribute``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.operators.attribution import attribute_co_located
from adlift.operators.baseline import sales_without_ads
from adlift.operators.normalize import SALE_KEYS


@dataclass(frozen=True)
class BucketedFacts:
    """Names of the two tables. ``day`` (a copy of ``date``) is their partition column."""

    spark: SparkSession
    sales_table: str
    placements_table: str

    def _scan(self, name: str, start: dt.date, end: dt.date) -> DataFrame:
        # Both columns: ``day`` skips folders, ``date`` is the one that joins.
        return self.spark.table(name).where(F.col("day").between(F.lit(start), F.lit(end))).drop("day")

    def sales(self, start: dt.date, end: dt.date) -> DataFrame:
        return self._scan(self.sales_table, start, end)

    def placements(self, start: dt.date, end: dt.date) -> DataFrame:
        return self._scan(self.placements_table, start, end)

    def winners(self, start: dt.date, end: dt.date, grace_seconds: int) -> DataFrame:
        """J2+F3+W2 over [start, end], as :func:`adlift.operators.attribution.attribute`."""
        return attribute_co_located(self.sales(start, end), self.placements(start, end), grace_seconds)

    def sales_without_ads(self, start: dt.date, end: dt.date, k: int | None = None) -> DataFrame:
        """J1 over [start, end]."""
        keys = self.placements(start, end).select(*SALE_KEYS).dropna().distinct()
        return sales_without_ads(self.sales(start, end), keys, start, end, k)


def write_bucketed(spark: SparkSession, sales_n: DataFrame, placements_x: DataFrame, name: str, path: str,
                   buckets: int, days: tuple[dt.date, dt.date] | None = None) -> BucketedFacts:
    """Write both facts below ``path`` as tables ``<name>_sales`` and ``<name>_placements``.

    ``days``: limit to rows of these days (first, last). Rows without a day belong to no run
    and are left out. One shuffle per fact, by bucket, so a bucket of a write is one file per day.
    """
    for table, rows in (("sales", sales_n), ("placements", placements_x)):
        rows = rows.where(F.col("date").isNotNull())
        if days is not None:
            rows = rows.where(F.col("date").between(*map(F.lit, days)))
        (
            rows.withColumn("day", F.col("date")).repartition(buckets, *SALE_KEYS)
            .write.mode("overwrite").partitionBy("day").bucketBy(buckets, *SALE_KEYS).sortBy(*SALE_KEYS)
            .option("path", f"{path.rstrip('/')}/{table}").saveAsTable(f"{name}_{table}")
        )
    return BucketedFacts(spark, f"{name}_sales", f"{name}_placements")
