"""Increments over the baseline and the daily sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.contracts import DAILY_CONVERSIONS, SOURCE_TYPED
from adlift.functions import exact
from adlift.functions.dates import sales_date_padded
from adlift.functions.numeric import STABLE_DECIMALS, clamped_increment, money, truncated_units
from adlift.operators.enrich import DIMENSION_JOINS

ATTRIBUTION_METHOD = "time_based_incremental"

# The 24 group keys, (column in the enriched rows, output name), in
# the job's order. sales_date is derived first.
GROUP_KEYS = (
    ("sales_date", "sales_date"),
    ("organization_name", "retailer_name"),
    ("advertiserorgid", "advertiser_org_id"),
    ("daily_budget", "daily_budget"),
    ("status", "status"),
    ("campaign_type", "campaign_type"),
    ("campaign_name", "campaign_name"),
    ("adproduct", "ad_product"),
    ("ad_group_name", "ad_group_name"),
    ("ad_name", "ad_name"),
    ("state", "state"),
    ("city", "city"),
    ("location_name", "location_name"),
    ("category_name", "aisle_category_name"),
    ("sku", "sku"),
    ("product_name", "product_name"),
    ("winningcurrencycode", "winning_currency_code"),
    ("campaignid", "campaign_id"),
    ("adgroupid", "adgroup_id"),
    ("offercode", "offer_code"),
    ("location_id", "location"),
    ("sales_year", "sales_year"),
    ("sales_month", "sales_month"),
    ("sales_day", "sales_day"),
)
# The first form of the job groups by 20 keys: no sales_date and no year/month/day
# (its day is the loop day, here the ``date`` key).
GROUP_KEYS_20 = tuple(k for k in GROUP_KEYS if k[1] not in ("sales_date", "sales_year", "sales_month", "sales_day"))


def incremental_rows(attributed: DataFrame, baseline: DataFrame) -> DataFrame:
    """J9 + N18/N19: per attributed sale, units and amount above the baseline, >= 0.

    A SKU without a baseline that day keeps its row with increments 0. SKUs meet
    null-safely: attributed rows have no null SKU, so it changes no row, and no null
    filter goes into the baseline's plan, which stays the one that the day gate reads.
    """
    side = baseline.withColumnsRenamed({"date": "_date", "sku": "_sku"})
    match = (attributed["date"] == side["_date"]) & attributed["sku"].eqNullSafe(side["_sku"])
    j = attributed.join(side, match, "left").drop("_date", "_sku")
    return j.withColumns({
        "incremental_units_sold": clamped_increment("units_sold", "avg_units_sold_no_ad_traffic"),
        "incremental_sales": clamped_increment("sale_amount", "avg_sales_no_ad_traffic"),
    })


# The two measures and the names of their running sums' parts.
MEASURES = (("incremental_units_sold", "_units"), ("incremental_sales", "_sales"))


def _totals(rows: DataFrame, keys: list) -> DataFrame:
    """The measures of ``rows`` summed by ``keys`` as decimals ``_units`` and ``_sales``.

    Exact (``adlift.functions.exact``), so the order in which rows are added changes
    nothing. ``rows`` hold the measures, or the parts that :func:`sums_by_ids` left of them.
    """
    if "_units_whole" not in rows.columns:
        rows = rows.select("*", *[c for m, n in MEASURES for c in exact.parts(n, m)])
    agg = rows.groupBy(*keys).agg(*[c for _, n in MEASURES for c in exact.summed(n)])
    return agg.withColumns({n: exact.total(n) for _, n in MEASURES}).drop(
        *[p for _, n in MEASURES for p in exact.part_names(n)])


def daily_sums(rows: DataFrame) -> DataFrame:
    """A2: sums over the 24 keys (nulls group together), then the output casts."""
    rows = rows.withColumn("sales_date", sales_date_padded("sales_year", "sales_month", "sales_day"))
    agg = _totals(rows, [F.col(src).alias(dst) for src, dst in GROUP_KEYS])
    types = {f.name: f.dataType for f in DAILY_CONVERSIONS.fields}
    given = {f.name: f.dataType for f in agg.schema.fields}
    out = []
    for f in DAILY_CONVERSIONS.fields:
        if f.name == "units_sold":
            out.append(truncated_units("_units").alias("units_sold"))
        elif f.name == "sales":
            out.append(money("_sales").alias("sales"))
        elif f.name == "attribution_method":
            out.append(F.lit(ATTRIBUTION_METHOD).alias(f.name))
        elif f.name in SOURCE_TYPED and not isinstance(given[f.name], T.IntegralType):
            out.append(F.col(f.name))  # text ids stay text
        else:
            out.append(F.col(f.name).try_cast(types[f.name]).alias(f.name))
    return agg.select(*out)


def sums_by_ids(rows: DataFrame) -> DataFrame:
    """The increments' parts summed over everything the output groups by but dimension names.

    Names depend on ids, so the dimensions join these groups instead of single
    sales; a repeated dimension id multiplies a sum as it would its rows.
    """
    ids = {c for _, c, _ in DIMENSION_JOINS}
    own = [src for src, _ in GROUP_KEYS if src in rows.columns]
    keys = list(dict.fromkeys(["date", *own, *sorted(ids)]))
    cut = rows.select(*keys, *[c for m, n in MEASURES for c in exact.parts(n, m)])
    return cut.groupBy(*keys).agg(*[c for _, n in MEASURES for c in exact.summed(n)])


def daily_sums_20key(rows: DataFrame) -> DataFrame:
    """The 20-key form, one result per loop day, no output casts."""
    agg = _totals(rows, [F.col("date").alias("sales_date"), *[F.col(s).alias(d) for s, d in GROUP_KEYS_20]])
    return agg.select(
        "sales_date", *[d for _, d in GROUP_KEYS_20],
        F.round("_units", STABLE_DECIMALS).cast("double").alias("units_sold"),
        F.round(F.round("_sales", STABLE_DECIMALS), 2).cast("double").alias("sales"),
        F.lit(ATTRIBUTION_METHOD).alias("attribution_method"),
    )
