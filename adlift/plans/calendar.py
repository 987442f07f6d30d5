"""The run window as a DataFrame of days (no driver-side loop)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.config import RunConfig


def run_calendar(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """One row per day in [start, end], inclusive. Its size is the run length."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(cfg.start), F.lit(cfg.end))).alias("date"))


def run_calendar_with_inputs(spark: SparkSession, cfg: RunConfig, sales_n: DataFrame,
                             placements_t: DataFrame) -> DataFrame:
    """The run days with each day's history window and the input rows found.

    ``history_from``/``history_to`` are the bounds the job's day loop uses for that
    day's baseline (D - lookback .. D - 1). The per-day counts are aggregates of at
    most one row per day, so they join the calendar by broadcast.
    """
    per_day_sales = sales_n.groupBy("date").agg(F.count(F.lit(1)).alias("n_sales"))
    per_day_ads = placements_t.groupBy("date").agg(F.count(F.lit(1)).alias("n_placements"))
    cal = run_calendar(spark, cfg)
    out = cal.join(F.broadcast(per_day_sales), "date", "left").join(F.broadcast(per_day_ads), "date", "left")
    return out.select(
        "date",
        F.date_sub("date", cfg.lookback_days).alias("history_from"),
        F.date_sub("date", 1).alias("history_to"),
        F.coalesce("n_sales", F.lit(0)).cast("long").alias("n_sales"),
        F.coalesce("n_placements", F.lit(0)).cast("long").alias("n_placements"),
    )
