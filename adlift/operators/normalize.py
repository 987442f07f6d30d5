"""Input normalisation: one typed, narrow row shape per fact.

Normalised sales: order_id, sku (string), location_id, units_sold, sale_amount
(double), ts_sec (epoch seconds), date, sales_year/month/day (int) and the output
columns that sales own (by default product_name, state, city).

Normalised placements, one row per tracked SKU: placement_id, date (UTC day of the
begin time), sku, location_id, begin_sec, end_sec, bid amounts and the ids and
labels the output groups by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.config import RunConfig
from adlift.contracts import PLACEMENT_COLUMNS, SALES_COLUMNS, require_columns
from adlift.functions.dates import (
    date_from_epoch_seconds,
    date_from_parts,
    date_from_text_time,
    epoch_ms_to_seconds,
    epoch_seconds_from_text,
    epoch_seconds_from_value,
)
from adlift.functions.numeric import resolve_choice

SALE_KEYS = ("date", "sku", "location_id")

# Placement columns carried to the output, lower-case as the analyzer resolves them.
PLACEMENT_PAYLOAD = (
    "aislecategoryid", "campaignid", "retailerorgid", "adgroupid", "winningadid",
    "advertiserorgid", "adproduct", "winningcurrencycode", "offercode",
)


# Output columns that sales usually own (see ``contracts.column_owners``).
SALES_OWNED = ("product_name", "state", "city")


def sale_seconds(cfg: RunConfig):
    return epoch_seconds_from_text("timestamp") if cfg.sale_time_format == "text" else epoch_seconds_from_value("timestamp")


def normalize_sales(sales: DataFrame, cfg: RunConfig, owned: tuple[str, ...] = SALES_OWNED,
                    raw: tuple[str, ...] = ()) -> DataFrame:
    """Typed sales rows (and the ``raw`` columns as they are).

    ``date`` comes from the partition parts (default) or from the sale time.
    ``sales_year/month/day``, the output partitions, are the parts of that same date (the
    integer partition parts in the first case), so a run writes only its own days.
    """
    require_columns(sales, SALES_COLUMNS, "sales")
    ts = sale_seconds(cfg)
    if cfg.sales_date_source == "parts":
        day = date_from_parts("year", "month", "day")
    elif cfg.sale_time_format == "text":
        day = date_from_text_time("timestamp")
    else:
        day = date_from_epoch_seconds(ts)
    if cfg.sales_date_source == "parts":
        parts = [F.col(c).try_cast("int").alias(f"sales_{c}") for c in ("year", "month", "day")]
    else:
        parts = [F.year(day).alias("sales_year"), F.month(day).alias("sales_month"), F.dayofmonth(day).alias("sales_day")]
    return sales.select(
        F.col("order_id"),
        F.col("sku").cast("string").alias("sku"),
        F.col("location_id"),
        F.col("units_sold"),
        resolve_choice(sales, "sale_amount").alias("sale_amount"),
        ts.alias("ts_sec"),
        day.alias("date"),
        *parts,
        *[F.col(c).alias(c) for c in (*owned, *raw)],
    )


def placement_times(placements: DataFrame, owned: tuple[str, ...] = ()) -> DataFrame:
    """begin/end as epoch seconds and the begin day, before exploding."""
    require_columns(placements, PLACEMENT_COLUMNS, "placements")
    pid = F.col("placement_id") if "placement_id" in [c.lower() for c in placements.columns] else F.lit(None).cast("long")
    begin = epoch_ms_to_seconds("begintime")
    return placements.select(
        pid.alias("placement_id"),
        begin.alias("begin_sec"),
        epoch_ms_to_seconds("endtime").alias("end_sec"),
        date_from_epoch_seconds(begin).alias("date"),
        F.col("locationid").alias("location_id"),
        F.col("trackedskus"),
        resolve_choice(placements, "winningbidamount").alias("winningbidamount"),
        resolve_choice(placements, "winningbidprice").alias("winningbidprice"),
        *[F.col(c).alias(c) for c in (*PLACEMENT_PAYLOAD, *owned)],
        # Partition parts keep a placement_ prefix so they never clash with sales.
        F.col("year").alias("placement_year"),
        F.col("month").alias("placement_month"),
        F.col("day").alias("placement_day"),
    )


def explode_tracked_skus(placements_timed: DataFrame) -> DataFrame:
    """One row per tracked SKU, as string; null or empty arrays yield no row."""
    cols = [c for c in placements_timed.columns if c != "trackedskus"]
    at = cols.index("date") + 1
    return placements_timed.select(*cols, F.explode("trackedskus").alias("_sku")).select(
        *cols[:at], F.col("_sku").cast("string").alias("sku"), *cols[at:]
    )


def normalize_placements(placements: DataFrame, owned: tuple[str, ...] = ()) -> DataFrame:
    return explode_tracked_skus(placement_times(placements, owned))


def placement_keys(placements: DataFrame) -> DataFrame:
    """Distinct (date, sku, location_id) that had an ad; narrow before the explode."""
    p = placements.select(
        date_from_epoch_seconds(epoch_ms_to_seconds("begintime")).alias("date"),
        F.col("locationid").alias("location_id"),
        F.explode("trackedskus").alias("_sku"),
    )
    keys = p.select("date", F.col("_sku").cast("string").alias("sku"), "location_id")
    # Null keys never match an equi-join, so dropping them early is exact.
    return keys.dropna(subset=list(SALE_KEYS)).distinct()
