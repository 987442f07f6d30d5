"""Declared schemas: what the job reads and what it writes (Q3/Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns the job needs from each raw input, by lower-case name. Types of the raw
# inputs vary between deployments (ids int or long, amounts double or a choice
# struct), so inputs are checked for presence and normalised by explicit casts.
SALES_COLUMNS = (
    "order_id", "sku", "location_id", "units_sold", "sale_amount", "timestamp",
    "year", "month", "day",
)
PLACEMENT_COLUMNS = (
    "begintime", "endtime", "locationid", "trackedskus", "winningbidamount", "winningbidprice",
    "aislecategoryid", "campaignid", "retailerorgid", "adgroupid", "winningadid",
    "advertiserorgid", "adproduct", "winningcurrencycode", "offercode", "year", "month", "day",
)
DIMENSION_COLUMNS = {
    "categories": ("id", "name"),
    "campaigns": ("id", "name"),
    "organizations": ("id", "name"),
    "locations": ("id", "name"),
    "ad_groups": ("id", "name"),
    "ads": ("id", "name"),
}

# The job names these output columns without a table: whichever of the tables joined by
# then has one, owns it. Fixed values.
OWNED_COLUMNS = ("product_name", "state", "city", "status", "campaign_type", "daily_budget")
OWNER_TABLES = ("sales", "placements", "categories", "campaigns", "organizations")

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_MONEY = T.DecimalType(10, 2)

# The output table: 27 columns in the job's order.
DAILY_CONVERSIONS = T.StructType([
    T.StructField("sales_date", T.DateType()),
    T.StructField("retailer_name", _S),
    T.StructField("advertiser_org_id", _L),
    T.StructField("daily_budget", _MONEY),
    T.StructField("status", _S),
    T.StructField("campaign_type", _S),
    T.StructField("campaign_name", _S),
    T.StructField("ad_product", _S),
    T.StructField("ad_group_name", _S),
    T.StructField("ad_name", _S),
    T.StructField("state", _S),
    T.StructField("city", _S),
    T.StructField("location_name", _S),
    T.StructField("aisle_category_name", _S),
    T.StructField("sku", _S),
    T.StructField("product_name", _S),
    T.StructField("winning_currency_code", _S),
    T.StructField("campaign_id", _L),
    T.StructField("adgroup_id", _L),
    T.StructField("offer_code", _S),
    T.StructField("location", _L),
    T.StructField("sales_year", _I),
    T.StructField("sales_month", _I),
    T.StructField("sales_day", _I),
    T.StructField("units_sold", _I),
    T.StructField("sales", _MONEY),
    T.StructField("attribution_method", _S),
])

# Ids the job writes as its source has them: integers as long, text as text.
SOURCE_TYPED = ("advertiser_org_id", "campaign_id", "adgroup_id", "location")


def missing_columns(df: DataFrame, required) -> list[str]:
    """Q5: required columns absent from ``df`` (case-insensitive, like the analyzer)."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def require_columns(df: DataFrame, required, what: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; has {df.columns}")
    return df


def column_owners(tables: dict[str, DataFrame], chosen: dict[str, str] | None = None) -> dict[str, str]:
    """The table each of ``OWNED_COLUMNS`` is taken from, by name.

    A column that several tables have needs a choice (``chosen``: column -> table); one
    that none has is an error, raised before anything is read.
    """
    chosen = dict(chosen or {})
    unknown = sorted(set(chosen) - set(OWNED_COLUMNS))
    if unknown:
        raise ValueError(f"no owner can be chosen for {unknown}; only for {list(OWNED_COLUMNS)}")
    out = {}
    for column in OWNED_COLUMNS:
        have = [t for t in OWNER_TABLES if not missing_columns(tables[t], [column])]
        if column in chosen and chosen[column] not in have:
            raise ValueError(f"{chosen[column]!r} was chosen for column {column!r}, which only {have} have")
        if column not in chosen and len(have) != 1:
            raise ValueError(f"column {column!r} is in {have or 'none'} of {list(OWNER_TABLES)}; "
                             "choose one in RunConfig.column_owners")
        out[column] = chosen.get(column, have[0])
    return out


def schema_mismatches(df: DataFrame, expected: T.StructType) -> list[str]:
    """Q3: differences between ``df``'s schema and a contract (name, type, order)."""
    given = {f.name: f.dataType for f in df.schema.fields}
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, given.get(f.name) if f.name in SOURCE_TYPED and f.name in given else f.dataType)
            for f in expected.fields]
    if got == want:
        return []
    out = []
    for i in range(max(len(got), len(want))):
        g = got[i] if i < len(got) else None
        w = want[i] if i < len(want) else None
        if g != w:
            out.append(f"column {i}: got {g}, want {w}")
    return out
