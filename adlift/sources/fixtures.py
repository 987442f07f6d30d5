"""The job's inputs derived from the driver's generated tables.

The driver ships TPC-H-style tables plus an ``events`` table, not retail sales and
ad placements. Purchases become sales, views and clicks become ad placements, and
nation / region / supplier / part give the six dimensions. The Spark derivation
(``load``) and the DuckDB text the oracle queries start from (``ORACLE_CTES``) live
side by side here so they stay in step.

Some dimension ids miss on purpose (retailerorgid 5, adgroupid above 25,
aislecategoryid 7-8) and some tracked-SKU arrays are null or empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlift.functions.dates import ntz_to_epoch_seconds
from adlift.sources.bundle import Sources


# Declared schemas of the driver tables the derivation reads: no inference pass
# over file footers at plan time.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class _Tables:
    """Each driver table read once per load (one file listing per table)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._seen = spark, sf_dir, {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = _read(self.spark, self.sf_dir, name)
        return self._seen[name]


def _events(tables: _Tables) -> DataFrame:
    ev = tables("events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        ntz_to_epoch_seconds("ts").alias("sec"),
    )


def sales(tables: _Tables) -> DataFrame:
    """Purchases as sales rows, partition columns year/month/day included."""
    ev = _events(tables).where(F.col("event_type") == "purchase")
    part = tables("part").select("p_partkey", "p_name")
    j = ev.join(part, ev.k == part.p_partkey, "left")
    return j.select(
        F.col("event_id").alias("order_id"),
        F.col("k").cast("string").alias("sku"),
        (F.col("user_id") % 25).cast("int").alias("location_id"),
        (1 + F.col("k") % 5 + F.col("event_id") % 4).cast("int").alias("units_sold"),
        F.col("value").alias("sale_amount"),
        F.col("sec").cast("string").alias("timestamp"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.concat(F.lit("State_"), (F.col("user_id") % 5).cast("string")).alias("state"),
        F.concat(F.lit("City_"), (F.col("user_id") % 25).cast("string")).alias("city"),
        F.col("p_name").alias("product_name"),
    )


def placements(tables: _Tables) -> DataFrame:
    """Views and clicks as winning ad placements (epoch-ms times, SKU arrays)."""
    ev = _events(tables).where(F.col("event_type").isin("view", "click"))
    eid = F.col("event_id")
    k = F.col("k")
    skus = (
        F.when(eid % 97 == 0, F.lit(None).cast("array<int>"))
        .when(eid % 89 == 0, F.array().cast("array<int>"))
        .otherwise(F.array(k % 100, (k + 1) % 100, (k + 2) % 100))
    )
    return ev.select(
        eid.alias("placement_id"),
        (F.col("sec") * 1000).alias("begintime"),
        ((F.col("sec") + 600 * (1 + eid % 12)) * 1000).alias("endtime"),
        (F.col("user_id") % 25).cast("int").alias("locationid"),
        skus.alias("trackedskus"),
        F.col("value").alias("winningbidamount"),
        (F.col("value") / 2).alias("winningbidprice"),
        (eid % 200).cast("long").alias("winningadid"),
        (eid % 12).cast("long").alias("campaignid"),
        (1 + eid % 30).cast("int").alias("adgroupid"),
        (eid % 6).cast("int").alias("retailerorgid"),
        (1 + eid % 8).cast("int").alias("aislecategoryid"),
        (eid % 5).cast("int").alias("advertiserorgid"),
        F.when(eid % 2 == 0, "banner").otherwise("search").alias("adproduct"),
        F.lit("USD").alias("winningcurrencycode"),
        F.when(eid % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("OFFER_"), (eid % 3).cast("string"))).alias("offercode"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )


def dimensions(tables: _Tables) -> dict[str, DataFrame]:
    nation, region, supplier, part = tables("nation"), tables("region"), tables("supplier"), tables("part")
    sid = F.col("s_suppkey")
    # Category ids number the distinct part types in name order. The distinct set
    # is the fixed type vocabulary, so the ordering window runs on a handful of rows.
    types = part.select("p_type").distinct()
    categories = types.select(
        F.row_number().over(Window.orderBy("p_type")).cast("int").alias("id"),
        F.col("p_type").alias("name"),
    )
    return {
        "categories": categories,
        "campaigns": supplier.select(
            sid.alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("daily_budget"),
            F.when(sid % 2 == 0, "active").otherwise("paused").alias("status"),
            F.when(sid % 3 == 0, "offsite").otherwise("onsite").alias("campaign_type"),
        ),
        "organizations": region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "locations": nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "ad_groups": part.select(
            F.expr("substr(p_brand, 7)").try_cast("int").alias("id"), F.col("p_brand").alias("name")
        ).distinct(),
        "ads": part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
    }


def load(spark: SparkSession, sf_dir: str) -> Sources:
    """All eight inputs over one scale-factor directory (lazy plans, nothing read yet)."""
    tables = _Tables(spark, sf_dir)
    return Sources(sales=sales(tables), placements=placements(tables), **dimensions(tables))


# DuckDB form of the same derivation, already normalised (what the engine's
# normalise step produces), as leading CTEs for the oracle queries. The driver
# registers the base tables as views.
ORACLE_CTES = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec
  FROM events),
sales AS (
  SELECT e.event_id AS order_id, CAST(e.k AS VARCHAR) AS sku,
         CAST(e.user_id % 25 AS INTEGER) AS location_id,
         CAST(1 + e.k % 5 + e.event_id % 4 AS INTEGER) AS units_sold,
         e.value AS sale_amount, e.sec AS ts_sec, CAST(e.ts AS DATE) AS date,
         CAST(year(e.ts) AS INTEGER) AS sales_year, CAST(month(e.ts) AS INTEGER) AS sales_month,
         CAST(day(e.ts) AS INTEGER) AS sales_day,
         'State_' || CAST(e.user_id % 5 AS VARCHAR) AS state,
         'City_' || CAST(e.user_id % 25 AS VARCHAR) AS city, p.p_name AS product_name
  FROM ev e LEFT JOIN part p ON p.p_partkey = e.k
  WHERE e.event_type = 'purchase'),
placements AS (
  SELECT event_id AS placement_id, sec AS begin_sec, sec + 600 * (1 + event_id % 12) AS end_sec,
         DATE '1970-01-01' + CAST(floor(sec / 86400) AS INTEGER) AS date,
         CAST(user_id % 25 AS INTEGER) AS location_id,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN []::INTEGER[]
              ELSE [k % 100, (k + 1) % 100, (k + 2) % 100] END AS trackedskus,
         value AS winningbidamount, value / 2 AS winningbidprice,
         CAST(event_id % 200 AS BIGINT) AS winningadid, CAST(event_id % 12 AS BIGINT) AS campaignid,
         CAST(1 + event_id % 30 AS INTEGER) AS adgroupid, CAST(event_id % 6 AS INTEGER) AS retailerorgid,
         CAST(1 + event_id % 8 AS INTEGER) AS aislecategoryid, CAST(event_id % 5 AS INTEGER) AS advertiserorgid,
         CASE WHEN event_id % 2 = 0 THEN 'banner' ELSE 'search' END AS adproduct,
         'USD' AS winningcurrencycode,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'OFFER_' || CAST(event_id % 3 AS VARCHAR) END AS offercode
  FROM ev WHERE event_type IN ('view', 'click')),
placements_x AS (
  SELECT * EXCLUDE (trackedskus, sk), CAST(sk AS VARCHAR) AS sku
  FROM (SELECT *, unnest(trackedskus) AS sk FROM placements)),
locations AS (SELECT n_nationkey AS id, n_name AS name FROM nation),
organizations AS (SELECT r_regionkey AS id, r_name AS name FROM region),
campaigns AS (
  SELECT s_suppkey AS id, s_name AS name, s_acctbal AS daily_budget,
         CASE WHEN s_suppkey % 2 = 0 THEN 'active' ELSE 'paused' END AS status,
         CASE WHEN s_suppkey % 3 = 0 THEN 'offsite' ELSE 'onsite' END AS campaign_type
  FROM supplier),
categories AS (
  SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS id, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part)),
ad_groups AS (SELECT DISTINCT TRY_CAST(substr(p_brand, 7) AS INTEGER) AS id, p_brand AS name FROM part),
ads AS (SELECT p_partkey AS id, p_name AS name FROM part)
"""

