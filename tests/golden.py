"""The hand-worked case of FIXTURES.md §2 as Spark inputs (run 2024-10-02..03, UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from adlift.sources.bundle import Sources

UTC = dt.timezone.utc


def epoch(s: str) -> int:
    return int(dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S").replace(tzinfo=UTC).timestamp())


SALES_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("sku", T.StringType()),
    T.StructField("location_id", T.IntegerType()), T.StructField("units_sold", T.IntegerType()),
    T.StructField("sale_amount", T.DoubleType()), T.StructField("timestamp", T.StringType()),
    T.StructField("year", T.StringType()), T.StructField("month", T.StringType()), T.StructField("day", T.StringType()),
    T.StructField("product_name", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("city", T.StringType()),
])

PLACEMENTS_SCHEMA = T.StructType([
    T.StructField("placement_id", T.StringType()), T.StructField("begintime", T.LongType()),
    T.StructField("endtime", T.LongType()), T.StructField("locationid", T.IntegerType()),
    T.StructField("trackedskus", T.ArrayType(T.StringType())),
    T.StructField("winningbidamount", T.DoubleType()), T.StructField("winningbidprice", T.DoubleType()),
    T.StructField("aislecategoryid", T.LongType()), T.StructField("campaignid", T.LongType()),
    T.StructField("retailerorgid", T.LongType()), T.StructField("adgroupid", T.LongType()),
    T.StructField("winningadid", T.LongType()), T.StructField("advertiserOrgId", T.LongType()),
    T.StructField("adProduct", T.StringType()), T.StructField("winningCurrencyCode", T.StringType()),
    T.StructField("offerCode", T.StringType()),
    T.StructField("year", T.StringType()), T.StructField("month", T.StringType()), T.StructField("day", T.StringType()),
])

# (order, sku, location, time, units, amount)
SALES = [
    ("o1", "A", 1, "2024-09-30 10:00:00", 2, 20.00),
    ("o2", "A", 1, "2024-09-29 10:00:00", 4, 40.00),
    ("o3", "A", 2, "2024-09-28 10:00:00", 7, 60.00),
    ("o4", "A", 1, "2024-09-27 10:00:00", 100, 1000.00),
    ("o5", "A", 1, "2024-10-01 10:00:00", 50, 500.00),
    ("o6", "A", 1, "2024-10-02 10:00:00", 7, 70.50),
    ("o7", "A", 1, "2024-10-02 15:00:01", 9, 90.00),
    ("o8", "A", 1, "2024-10-02 12:00:00", 1, 10.00),
    ("o9", "B", 1, "2024-10-02 10:00:00", 5, 55.00),
    ("o10", "A", 3, "2024-10-02 10:00:00", 3, 30.00),
]

# (id, skus, location, begin, end); campaign ids are all distinct
PLACEMENTS = [
    ("p0", ["A"], 1, "2024-10-01 20:00:00", "2024-10-01 21:00:00"),
    ("p1", ["A", "B"], 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00"),
    ("p2", ["A"], 1, "2024-10-02 06:00:00", "2024-10-02 08:00:00"),
    ("p3", ["A"], 1, "2024-10-02 12:00:00", "2024-10-02 13:00:00"),
    ("p4", [], 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00"),
    ("p5", None, 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00"),
]


def sales_rows(rows=SALES):
    out = []
    for o, sku, loc, t, u, a in rows:
        y, m, d = t[:10].split("-")
        # Unpadded month/day parts, as some partitioned tables store them.
        out.append((o, sku, loc, u, a, str(epoch(t)), y, str(int(m)), str(int(d)), f"product {sku}", "WA", "Seattle"))
    return out


def placement_rows(rows=PLACEMENTS):
    out = []
    for i, (pid, skus, loc, b, e) in enumerate(rows):
        y, m, d = b[:10].split("-")
        out.append((pid, epoch(b) * 1000, epoch(e) * 1000, loc, skus, 1.5, 0.75,
                    1, 100 + i, 7, 10 + i, 1000 + i, 5, "banner", "USD", None, y, m, d))
    return out


def sources(spark, sales=SALES, placements=PLACEMENTS) -> Sources:
    dims = {
        "categories": spark.createDataFrame([(1, "Snacks")], "id long, name string"),
        "campaigns": spark.createDataFrame(
            [(100 + i, f"campaign {i}", 50.0 + i, "active", "onsite") for i in range(len(PLACEMENTS))],
            "id long, name string, daily_budget double, status string, campaign_type string"),
        "organizations": spark.createDataFrame([(7, "Retailer")], "id long, name string"),
        "locations": spark.createDataFrame([(1, "Store 1"), (2, "Store 2")], "id int, name string"),
        "ad_groups": spark.createDataFrame([(10 + i, f"group {i}") for i in range(len(PLACEMENTS))], "id long, name string"),
        # ad 1003 (p3) is missing on purpose: the name is null, the row stays.
        "ads": spark.createDataFrame([(1000 + i, f"ad {i}") for i in range(len(PLACEMENTS)) if i != 3],
                                     "id long, name string"),
    }
    return Sources(
        sales=spark.createDataFrame(sales_rows(sales), SALES_SCHEMA),
        placements=spark.createDataFrame(placement_rows(placements), PLACEMENTS_SCHEMA),
        **dims,
    )
