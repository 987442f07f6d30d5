"""Reading the facts by date range and the dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.functions.dates import partition_day_predicate
from adlift.sources.bundle import DIMENSIONS, Sources


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table``) or a path (anything with a '/' or a scheme)."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def scan_date_range(df: DataFrame, start: dt.date, end: dt.date,
                    year: str = "year", month: str = "month", day: str = "day") -> DataFrame:
    """Rows of a year/month/day partitioned table within [start, end].

    The predicate touches partition columns only, so a partitioned source reads
    just the matching day directories (``PartitionFilters`` in the plan).
    """
    return df.where(partition_day_predicate(start, end, year, month, day))


def jdbc_options(url: str, table: str, properties: dict | None = None, fetch_size: int = 10_000,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None) -> dict[str, str]:
    """Reader options for one table: rows per fetch, and a split by a numeric column if asked for.

    ``properties`` are passed on (user, password, driver ...); a ``query`` among them
    replaces the table, which Spark cannot split by a column.
    """
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if "query" in out:
        if partition_column is not None:
            raise ValueError("a query cannot be split by a column; give a table")
        del out["dbtable"]
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partition column needs its lower and upper bound and a number of partitions")
        out |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions)}
    return out


def read_jdbc_dimension(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                        **options) -> DataFrame:
    """S3: one dimension table over JDBC; ``options`` as in :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **options)).load()


def from_catalog(spark: SparkSession, sales: str, placements: str, dimensions: dict[str, str] | None = None,
                 jdbc_url: str | None = None, jdbc_properties: dict | None = None,
                 jdbc_read: dict[str, dict] | None = None) -> Sources:
    """Bind a run to catalog tables / paths, dimensions by name or over JDBC.

    ``jdbc_read``: per dimension, the keyword arguments of :func:`jdbc_options` for it.
    """
    dims = {}
    for name in DIMENSIONS:
        if dimensions and name in dimensions:
            dims[name] = read_table(spark, dimensions[name])
        elif jdbc_url:
            dims[name] = read_jdbc_dimension(spark, jdbc_url, name, jdbc_properties, **(jdbc_read or {}).get(name, {}))
        else:
            raise ValueError(f"no source for dimension {name!r}")
    return Sources(sales=read_table(spark, sales), placements=read_table(spark, placements), **dims)


def empty_ones(tables: dict[str, DataFrame]) -> list[str]:
    """The names of the tables without a row (one job, which takes at most one row of each)."""
    found = None
    for name, df in tables.items():
        one = df.limit(1).select(F.lit(name).alias("name"))
        found = one if found is None else found.unionByName(one)
    have = {r["name"] for r in found.collect()}
    return [name for name in tables if name not in have]
