"""K1: the partitioned Parquet sink for daily conversions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adlift.contracts import DAILY_CONVERSIONS
from adlift.sources.daytable import DayTable

OUTPUT_PARTITIONS = ("sales_year", "sales_month", "sales_day")


def output_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, OUTPUT_PARTITIONS)


def by_day(df: DataFrame) -> DataFrame:
    """Rows dealt out for a partitioned write.

    The hint keeps a day's rows together but lets AQE split a large day into several
    files instead of one task per day.
    """
    return df.hint("rebalance", *OUTPUT_PARTITIONS)


def write_daily_conversions(df: DataFrame, path: str, days: list[dt.date], mode: str = "overwrite") -> list[dt.date]:
    """Replace ``days`` (or add to them) in one commit; returns those that have rows.

    Rerunning a range is idempotent: its days are replaced, those that became empty
    are cleared, other days stay (see ``adlift.sources.daytable``).
    """
    return output_table(df.sparkSession, path).replace(by_day(df), days, mode)


def read_daily_conversions(spark: SparkSession, path: str, start: dt.date | None = None,
                           end: dt.date | None = None, schema: T.StructType = DAILY_CONVERSIONS) -> DataFrame:
    """Read the sink back with its declared schema (partition columns typed int).

    With ``start``/``end`` only those day directories are read (partition pruning).
    ``schema``: that of the written rows, where ids are text.
    """
    return output_table(spark, path).read(schema, start, end)
