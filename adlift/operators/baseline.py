"""The per-SKU baseline of sales without ads.

For day D the baseline of a SKU is the mean units and mean amount of its
``baseline_rows`` most recent sale rows in [D - lookback, D - 1] whose (day, sku,
location) had no placement. "Most recent" is over rows, pooled across locations.

All-days form, no per-day loop and no range join: a history row r (ranked by
day, time, order) is among the k most recent for day D exactly when

    r.date + 1 <= D <= min(r.date + lookback, date of the k-th row after r)

so each row gets a validity interval from one ``lead`` and is exploded over at most
``lookback`` days, clipped to the run window. Before that, rows are cut to the k
latest per (date, sku, location) and per (sku, date); both cuts are exact (an
older row of a day never outranks a newer one of the same day) and run partially
map-side, so a hot SKU reaches the per-SKU window with at most k rows per day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlift.config import RunConfig
from adlift.functions import exact
from adlift.operators.normalize import SALE_KEYS

# Recency order among history rows of one SKU (the job orders by day only; the
# rest are tie-breaks so results are repeatable). Most recent first, nulls last.
RECENCY = ("date", "ts_sec", "order_id", "location_id", "units_sold", "sale_amount")


def recent_first() -> list:
    return [F.col(c).desc_nulls_last() for c in RECENCY]


def oldest_first() -> list:
    """The exact reverse of :func:`recent_first`, for ``lead``."""
    return [F.col(c).asc_nulls_first() for c in RECENCY]


HISTORY_COLUMNS = ("date", "sku", "location_id", "ts_sec", "order_id", "units_sold", "sale_amount")


def _top(df: DataFrame, partition, k: int) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*recent_first())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def sales_without_ads(sales_n: DataFrame, keys: DataFrame, start: dt.date, end: dt.date, k: int | None = None) -> DataFrame:
    """Sale rows in [start, end] whose (date, sku, location_id) had no placement.

    With ``k`` set, only the k most recent rows of each (date, sku, location_id) are
    kept first: exact for the baseline, since the anti-join keeps or drops a
    (date, sku, location) group whole.
    """
    hist = sales_n.where(F.col("date").between(F.lit(start), F.lit(end))).select(*HISTORY_COLUMNS)
    if k is not None:
        hist = _top(hist, SALE_KEYS, k)
    return hist.join(keys, list(SALE_KEYS), "left_anti")


def daily_history(sales_n: DataFrame, keys: DataFrame, start: dt.date, end: dt.date, k: int) -> DataFrame:
    """Per (sku, day) in [start, end] its ``k`` most recent ad-free sale rows: all that any baseline can use.

    A day's rows depend on that day's sales and placements alone, so they can be kept
    (see ``adlift.sources.summary``) and pooled with other days' later.
    """
    return _top(sales_without_ads(sales_n, keys, start, end, k), ("sku", "date"), k)


def averages(rows: DataFrame, *keys: str) -> DataFrame:
    """A1: mean units and mean amount by ``keys``, exact sums divided once."""
    cut = rows.select(*keys, *exact.parts("_u", "units_sold"), *exact.parts("_a", "sale_amount"),
                      F.col("units_sold").isNotNull().cast("int").alias("_un"),
                      F.col("sale_amount").isNotNull().cast("int").alias("_an"))
    sums = cut.groupBy(*keys).agg(*exact.summed("_u"), *exact.summed("_a"),
                                  F.sum("_un").alias("_un"), F.sum("_an").alias("_an"))
    return sums.select(*keys, exact.mean("_u", "_un").alias("avg_units_sold_no_ad_traffic"),
                       exact.mean("_a", "_an").alias("avg_sales_no_ad_traffic"))


def baseline_single_day(sales_n: DataFrame, keys: DataFrame, day: dt.date, cfg: RunConfig) -> DataFrame:
    """P1 for one day D, the job's own form: (sku, avg units, avg amount)."""
    k = cfg.baseline_rows
    lo, hi = day - dt.timedelta(days=cfg.lookback_days), day - dt.timedelta(days=1)
    return averages(_top(daily_history(sales_n, keys, lo, hi, k), ("sku",), k), "sku")


def baseline_from_history(hist: DataFrame, cfg: RunConfig) -> DataFrame:
    """P1 for every run day from the days' histories (:func:`daily_history`, fresh or kept)."""
    k, back = cfg.baseline_rows, cfg.lookback_days
    later = F.lead("date", k).over(Window.partitionBy("sku").orderBy(*oldest_first()))
    last_day = F.date_add("date", back)
    valid = hist.select(
        "sku", "units_sold", "sale_amount",
        F.greatest(F.date_add("date", 1), F.lit(cfg.start)).alias("valid_from"),
        F.least(last_day, F.coalesce(later, last_day), F.lit(cfg.end)).alias("valid_to"),
    ).where(F.col("valid_from") <= F.col("valid_to"))
    days = valid.select(
        F.explode(F.sequence("valid_from", "valid_to")).alias("date"), "sku", "units_sold", "sale_amount"
    )
    return averages(days, "date", "sku")


def baseline_by_day(sales_n: DataFrame, keys: DataFrame, cfg: RunConfig) -> DataFrame:
    """P1 for every run day at once: (date, sku, avg units, avg amount)."""
    return baseline_from_history(daily_history(sales_n, keys, cfg.read_start, cfg.history_end, cfg.baseline_rows), cfg)


def gated_days(baseline: DataFrame) -> DataFrame:
    """Run days that have a baseline row for some SKU (others are skipped).

    At most one row per run day, so its size is bounded by the run config. The averages
    are counted, which filters nothing, so that the baseline keeps all its columns here:
    Spark then reuses the shuffle of the baseline join instead of reading history twice.
    """
    per_day = baseline.groupBy("date").agg(
        F.count("avg_units_sold_no_ad_traffic").alias("units"), F.count("avg_sales_no_ad_traffic").alias("sales"))
    return per_day.where((F.col("units") >= 0) & (F.col("sales") >= 0)).select("date")
