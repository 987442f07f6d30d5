"""DuckDB oracle SQL for every registered query (see ``adlift.queries``).

The SQL follows the job's own formulation: candidate pairs from an equi-join,
the two-branch time test, ``row_number`` for the winner, and a ranked baseline
computed day by day through a calendar join. Tables are the driver's views;
``adlift.sources.fixtures.ORACLE_CTES`` derives sales, placements and dimensions.
"""

from __future__ import annotations

import datetime as dt

from adlift.config import fixture_config
from adlift.queries import EMPTIED_DAY, LATE_FROM, LATE_LOCATION, SCAN_END, SCAN_START, SHORT_LOOKBACK, SINGLE_DAY
from adlift.sources.fixtures import ORACLE_CTES

_CFG = fixture_config()


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


START, END = _d(_CFG.start), _d(_CFG.end)
READ_START, HIST_END = _d(_CFG.read_start), _d(_CFG.history_end)
GRACE = _CFG.grace_seconds
K = _CFG.baseline_rows
BACK = _CFG.lookback_days

RECENCY = ("date DESC NULLS LAST, ts_sec DESC NULLS LAST, order_id DESC NULLS LAST, "
           "location_id DESC NULLS LAST, units_sold DESC NULLS LAST, sale_amount DESC NULLS LAST")

RUN = f"""
sales_run AS (SELECT * FROM sales WHERE date BETWEEN {START} AND {END}),
pl_run AS (SELECT * FROM placements_x WHERE date BETWEEN {START} AND {END})"""

PAIRS = f"""
pairs AS (
  SELECT s.date, s.order_id, s.sku, s.location_id, s.ts_sec, s.units_sold, s.sale_amount,
         s.sales_year, s.sales_month, s.sales_day, s.product_name, s.state, s.city,
         p.placement_id, p.begin_sec, p.end_sec, p.aislecategoryid, p.campaignid, p.retailerorgid,
         p.adgroupid, p.winningadid, p.advertiserorgid, p.adproduct, p.winningcurrencycode, p.offercode
  FROM sales_run s JOIN pl_run p
    ON s.date = p.date AND s.sku = p.sku AND s.location_id = p.location_id),
in_window AS (
  SELECT * FROM pairs
  WHERE (begin_sec <= ts_sec AND end_sec >= ts_sec) OR end_sec >= ts_sec - {GRACE})"""

WINNERS = f"""
winners AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY date, order_id, sku, location_id
      ORDER BY end_sec DESC NULLS LAST, begin_sec DESC NULLS LAST, placement_id DESC NULLS LAST,
               winningadid DESC NULLS LAST, campaignid DESC NULLS LAST, adgroupid DESC NULLS LAST,
               ts_sec ASC NULLS LAST, units_sold DESC NULLS LAST, sale_amount DESC NULLS LAST,
               product_name ASC NULLS LAST, state ASC NULLS LAST, city ASC NULLS LAST) AS rn
    FROM in_window)
  WHERE rn = 1)"""


def _no_ads(name: str, lo: str, hi: str) -> str:
    return f"""
{name} AS (
  SELECT s.* FROM sales s
  WHERE s.date BETWEEN {lo} AND {hi}
    AND NOT EXISTS (SELECT 1 FROM placements_x p
                    WHERE p.date = s.date AND p.sku = s.sku AND p.location_id = s.location_id))"""


BASELINE = _no_ads("nad", READ_START, HIST_END) + f""",
cal AS (SELECT CAST(d AS DATE) AS date FROM generate_series({START}, {END}, INTERVAL 1 DAY) AS t(d)),
ranked_b AS (
  SELECT c.date, n.sku, n.units_sold, n.sale_amount,
         row_number() OVER (PARTITION BY c.date, n.sku
           ORDER BY n.date DESC NULLS LAST, n.ts_sec DESC NULLS LAST, n.order_id DESC NULLS LAST,
                    n.location_id DESC NULLS LAST, n.units_sold DESC NULLS LAST,
                    n.sale_amount DESC NULLS LAST) AS rn
  FROM cal c JOIN nad n ON n.date BETWEEN c.date - {BACK} AND c.date - 1),
baseline AS (
  SELECT date, sku, avg(units_sold) AS avg_units_sold_no_ad_traffic,
         avg(sale_amount) AS avg_sales_no_ad_traffic
  FROM ranked_b WHERE rn <= {K} GROUP BY date, sku),
gated AS (SELECT DISTINCT date FROM baseline)"""

INCREMENTS = """
inc AS (
  SELECT w.*, b.avg_units_sold_no_ad_traffic, b.avg_sales_no_ad_traffic,
         CASE WHEN w.units_sold - b.avg_units_sold_no_ad_traffic > 0
              THEN w.units_sold - b.avg_units_sold_no_ad_traffic ELSE 0 END AS incremental_units_sold,
         CASE WHEN w.sale_amount - b.avg_sales_no_ad_traffic > 0
              THEN w.sale_amount - b.avg_sales_no_ad_traffic ELSE 0 END AS incremental_sales
  FROM winners w LEFT JOIN baseline b ON w.date = b.date AND w.sku = b.sku
  WHERE w.date IN (SELECT date FROM gated))"""

ENRICHED = """
enr AS (
  SELECT i.*, cat.name AS category_name, cam.name AS campaign_name, cam.daily_budget, cam.status,
         cam.campaign_type, org.name AS organization_name, loc.name AS location_name,
         ag.name AS ad_group_name, ad.name AS ad_name
  FROM inc i
  LEFT JOIN categories cat ON i.aislecategoryid = cat.id
  LEFT JOIN campaigns cam ON i.campaignid = cam.id
  LEFT JOIN organizations org ON i.retailerorgid = org.id
  LEFT JOIN locations loc ON i.location_id = loc.id
  LEFT JOIN ad_groups ag ON i.adgroupid = ag.id
  LEFT JOIN ads ad ON i.winningadid = ad.id)"""

# Cents: Spark's round() on a double rounds half-up on the double's shortest decimal
# form (75.615 -> 75.62), as the job does; DuckDB's round() on a double works on the
# binary value (75.6149999... -> 75.61). The oracle therefore rounds to cents in
# DECIMAL, which states the job's rounding exactly.
ATTRIBUTED = ",".join([RUN, PAIRS, WINNERS])
FULL = ",".join([RUN, PAIRS, WINNERS, BASELINE, INCREMENTS, ENRICHED])

DAILY_CONVERSIONS = f"""
SELECT make_date(sales_year, sales_month, sales_day) AS sales_date,
       organization_name AS retailer_name, CAST(advertiserorgid AS BIGINT) AS advertiser_org_id,
       CAST(daily_budget AS DECIMAL(10,2)) AS daily_budget, status, campaign_type, campaign_name,
       adproduct AS ad_product, ad_group_name, ad_name, state, city, location_name,
       category_name AS aisle_category_name, sku, product_name,
       winningcurrencycode AS winning_currency_code, CAST(campaignid AS BIGINT) AS campaign_id,
       CAST(adgroupid AS BIGINT) AS adgroup_id, offercode AS offer_code,
       CAST(location_id AS BIGINT) AS location, sales_year, sales_month, sales_day,
       CAST(trunc(round(sum(incremental_units_sold), 6)) AS INTEGER) AS units_sold,
       CAST(round(CAST(round(sum(incremental_sales), 6) AS DECIMAL(18,6)), 2) AS DECIMAL(10,2)) AS sales,
       'time_based_incremental' AS attribution_method
FROM enr
GROUP BY sales_year, sales_month, sales_day, organization_name, advertiserorgid, daily_budget, status,
         campaign_type, campaign_name, adproduct, ad_group_name, ad_name, state, city, location_name,
         category_name, sku, product_name, winningcurrencycode, campaignid, adgroupid, offercode, location_id"""

DAILY_CONVERSIONS_20 = """
SELECT date AS sales_date, organization_name AS retailer_name, advertiserorgid AS advertiser_org_id,
       daily_budget, status, campaign_type, campaign_name, adproduct AS ad_product, ad_group_name, ad_name,
       state, city, location_name, category_name AS aisle_category_name, sku, product_name,
       winningcurrencycode AS winning_currency_code, campaignid AS campaign_id, adgroupid AS adgroup_id,
       offercode AS offer_code, location_id AS location,
       round(sum(incremental_units_sold), 6) AS units_sold,
       CAST(round(CAST(round(sum(incremental_sales), 6) AS DECIMAL(18,6)), 2) AS DOUBLE) AS sales,
       'time_based_incremental' AS attribution_method
FROM enr
GROUP BY date, organization_name, advertiserorgid, daily_budget, status, campaign_type, campaign_name,
         adproduct, ad_group_name, ad_name, state, city, location_name, category_name, sku, product_name,
         winningcurrencycode, campaignid, adgroupid, offercode, location_id"""

CANDIDATES = f"""
cand AS (
  SELECT date, order_id, sku, location_id, CAST(count(*) AS BIGINT) AS n_pairs,
         CAST(count(*) FILTER (WHERE (begin_sec <= ts_sec AND end_sec >= ts_sec)
                                  OR end_sec >= ts_sec - {GRACE}) AS BIGINT) AS n_in_window
  FROM pairs GROUP BY date, order_id, sku, location_id)"""

_ENRICH_COLUMNS = {
    "categories": ("aislecategoryid", ["name AS category_name"]),
    "campaigns": ("campaignid", ["name AS campaign_name", "daily_budget", "status", "campaign_type"]),
    "organizations": ("retailerorgid", ["name AS organization_name"]),
    "locations": ("location_id", ["name AS location_name"]),
    "ad_groups": ("adgroupid", ["name AS ad_group_name"]),
    "ads": ("winningadid", ["name AS ad_name"]),
}


def _enrich_sql(names) -> str:
    cols, joins = [], []
    for i, n in enumerate(names):
        key, exprs = _ENRICH_COLUMNS[n]
        cols += [f"d{i}.{e}" for e in exprs]
        joins.append(f"LEFT JOIN {n} d{i} ON w.{key} = d{i}.id")
    return (f"SELECT w.date, w.order_id, w.sku, w.location_id, {', '.join(cols)}\nFROM winners w\n"
            + "\n".join(joins))


# The days whose own rows differ before and after the change, those whose history (at most K
# ad-free rows per SKU) differs, and the run days that either reaches.
_LATE = f"IN ({_d(LATE_FROM)}, {_d(LATE_FROM + dt.timedelta(days=9))})"
AFFECTED = f"""
sales_b AS (SELECT * FROM sales WHERE NOT (order_id % 50 = 7 AND date {_LATE})),
placements_b AS (SELECT * FROM placements_x WHERE NOT (location_id = {LATE_LOCATION} AND date = {_d(LATE_FROM)})),
own AS (
  SELECT DISTINCT date FROM sales WHERE order_id % 50 = 7 AND date {_LATE}
  UNION SELECT DISTINCT date FROM placements WHERE location_id = {LATE_LOCATION} AND date = {_d(LATE_FROM)}),
""" + ",\n".join(f"""
hist_{n} AS (
  SELECT date, sku, order_id FROM {sales} s
  WHERE NOT EXISTS (SELECT 1 FROM {ads} p WHERE p.date = s.date AND p.sku = s.sku AND p.location_id = s.location_id)
  QUALIFY row_number() OVER (PARTITION BY date, sku ORDER BY {RECENCY}) <= {K})"""
                 for n, sales, ads in (("b", "sales_b", "placements_b"), ("a", "sales", "placements_x"))) + """,
past AS (
  SELECT DISTINCT date FROM ((SELECT * FROM hist_a EXCEPT SELECT * FROM hist_b)
                             UNION ALL (SELECT * FROM hist_b EXCEPT SELECT * FROM hist_a)))"""


def _with(*ctes: str) -> str:
    return "WITH " + ORACLE_CTES.strip() + "".join("," + c for c in ctes if c) + "\n"


_SINGLE_LO = _d(SINGLE_DAY - dt.timedelta(days=BACK))
_SINGLE_HI = _d(SINGLE_DAY - dt.timedelta(days=1))

ORACLE = {
    "scan_date_range": _with() + f"""
SELECT order_id, sku, location_id, units_sold, sale_amount, CAST(ts_sec AS VARCHAR) AS "timestamp",
       sales_year AS year, sales_month AS month, sales_day AS day
FROM sales
WHERE sales_year * 10000 + sales_month * 100 + sales_day
      BETWEEN {SCAN_START.year * 10000 + SCAN_START.month * 100 + SCAN_START.day}
          AND {SCAN_END.year * 10000 + SCAN_END.month * 100 + SCAN_END.day}""",
    "run_calendar": _with(f"""
cal AS (SELECT CAST(d AS DATE) AS date FROM generate_series({START}, {END}, INTERVAL 1 DAY) AS t(d))""") + f"""
SELECT c.date, c.date - {BACK} AS history_from, c.date - 1 AS history_to,
       CAST((SELECT count(*) FROM sales s WHERE s.date = c.date) AS BIGINT) AS n_sales,
       CAST((SELECT count(*) FROM placements p WHERE p.date = c.date) AS BIGINT) AS n_placements
FROM cal c""",
    **{f"dim_{n}": _with() + f"SELECT * FROM {n}"
       for n in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")},
    "sink_roundtrip": _with(FULL) + DAILY_CONVERSIONS,
    "sales_date_from_parts": _with() + "SELECT order_id, date, sales_year, sales_month, sales_day FROM sales",
    "sales_date_from_ts": _with() + "SELECT order_id, date FROM sales",
    "placement_date": _with() + "SELECT placement_id, date FROM placements",
    "resolve_choice": _with() + """
SELECT placement_id, winningbidamount, winningbidprice,
       CASE WHEN placement_id % 2 = 0 THEN winningbidamount
            WHEN placement_id % 2 = 1 THEN CAST(CAST(floor(winningbidamount) AS INTEGER) AS DOUBLE)
       END AS bid_choice
FROM placements""",
    "explode_tracked_skus": _with() + "SELECT placement_id, date, sku, location_id FROM placements_x",
    "sale_timestamp_epoch": _with() + "SELECT order_id, ts_sec, make_timestamp(ts_sec * 1000000) AS sale_time FROM sales",
    "sale_timestamp_text": _with() + "SELECT order_id, ts_sec FROM sales",
    "placement_interval": _with() + """
SELECT placement_id, begin_sec, end_sec, make_timestamp(begin_sec * 1000000) AS begin_time,
       make_timestamp(end_sec * 1000000) AS end_time
FROM placements""",
    "sales_date_padded": _with() + """
SELECT order_id,
       CAST(strptime(CAST(sales_year AS VARCHAR) || lpad(CAST(sales_month AS VARCHAR), 2, '0')
                     || lpad(CAST(sales_day AS VARCHAR), 2, '0'), '%Y%m%d') AS DATE) AS sales_date
FROM sales""",
    "attribution_candidates": _with(RUN, PAIRS, CANDIDATES) + "SELECT * FROM cand",
    "attribution_winner": _with(ATTRIBUTED) + """
SELECT date, order_id, sku, location_id, ts_sec, placement_id, begin_sec, end_sec FROM winners""",
    "attribution_winner_bucketed": _with(ATTRIBUTED) + """
SELECT date, order_id, sku, location_id, ts_sec, placement_id, begin_sec, end_sec FROM winners""",
    "sales_without_ads_bucketed": _with(_no_ads("nad", READ_START, HIST_END)) + """
SELECT date, order_id, sku, location_id, ts_sec, units_sold, sale_amount FROM nad""",
    "sales_without_ads": _with(_no_ads("nad", READ_START, HIST_END)) + """
SELECT date, order_id, sku, location_id, ts_sec, units_sold, sale_amount FROM nad""",
    "baseline_single_day": _with(_no_ads("nad1", _SINGLE_LO, _SINGLE_HI)) + f"""
SELECT sku, round(avg(units_sold), 6) AS avg_units_sold_no_ad_traffic,
       round(avg(sale_amount), 6) AS avg_sales_no_ad_traffic
FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY {RECENCY}) AS rn FROM nad1)
WHERE rn <= {K}
GROUP BY sku""",
    "baseline_by_day": _with(BASELINE) + """
SELECT date, sku, round(avg_units_sold_no_ad_traffic, 6) AS avg_units_sold_no_ad_traffic,
       round(avg_sales_no_ad_traffic, 6) AS avg_sales_no_ad_traffic
FROM baseline""",
    "gated_days": _with(BASELINE) + "SELECT date FROM gated",
    **{f"enrich_{n}": _with(ATTRIBUTED) + _enrich_sql([n]) for n in _ENRICH_COLUMNS},
    "enrich_dims": _with(ATTRIBUTED) + _enrich_sql(list(_ENRICH_COLUMNS)),
    "incremental_rows": _with(ATTRIBUTED, BASELINE, INCREMENTS) + """
SELECT date, order_id, sku, location_id, units_sold, sale_amount,
       round(avg_units_sold_no_ad_traffic, 6) AS avg_units_sold_no_ad_traffic,
       round(avg_sales_no_ad_traffic, 6) AS avg_sales_no_ad_traffic,
       round(incremental_units_sold, 6) AS incremental_units_sold,
       round(incremental_sales, 6) AS incremental_sales
FROM inc""",
    "daily_conversions": _with(FULL) + DAILY_CONVERSIONS,
    "daily_conversions_20key": _with(FULL) + DAILY_CONVERSIONS_20,
    "daily_conversions_owner": _with(FULL.replace(
        "i.*,", "i.* EXCLUDE (state, city), 'State of ' || org.name AS state, 'City of ' || org.name AS city,"))
                               + DAILY_CONVERSIONS,
    "sink_rerun_timestamp_form": _with(FULL) + DAILY_CONVERSIONS,
    "sink_rerun_emptied_day": _with(FULL) + f"SELECT * FROM ({DAILY_CONVERSIONS}) WHERE sales_date <> {_d(EMPTIED_DAY)}",
    "empty_window": _with(FULL) + f"""
SELECT * FROM ({DAILY_CONVERSIONS}) WHERE sales_date NOT BETWEEN {_d(EMPTIED_DAY - dt.timedelta(days=1))} AND {_d(EMPTIED_DAY)}""",
    "baseline_from_summary": _with(BASELINE) + """
SELECT date, sku, round(avg_units_sold_no_ad_traffic, 6) AS avg_units_sold_no_ad_traffic,
       round(avg_sales_no_ad_traffic, 6) AS avg_sales_no_ad_traffic
FROM baseline""",
    "backfill_output": _with(FULL) + DAILY_CONVERSIONS,
    "affected_days": _with(AFFECTED) + f"""
SELECT * FROM (
  SELECT CAST(d AS DATE) AS date, EXISTS (SELECT 1 FROM own WHERE own.date = d) AS own_changed,
         EXISTS (SELECT 1 FROM past WHERE past.date BETWEEN CAST(d AS DATE) - {SHORT_LOOKBACK} AND CAST(d AS DATE) - 1) AS past_changed
  FROM generate_series({START}, {END}, INTERVAL 1 DAY) AS t(d))
WHERE own_changed OR past_changed""",
    "placement_partitions": _with() + """
SELECT placement_id, CAST(year(date) AS INTEGER) AS placement_year, CAST(month(date) AS INTEGER) AS placement_month,
       CAST(day(date) AS INTEGER) AS placement_day FROM placements""",
    "lookback_window": _with() + f"""
SELECT source, date, count(*) AS n_rows
FROM (SELECT 'sales' AS source, date FROM sales UNION ALL SELECT 'placements' AS source, date FROM placements)
WHERE date BETWEEN {_d(SCAN_START)} - 7 AND {_d(SCAN_END)} GROUP BY source, date""",
    "show_rows": _with() + """
SELECT order_id, sales_year AS year, sales_month AS month, sales_day AS day FROM sales ORDER BY order_id LIMIT 5""",
    "baseline_profile": _with(BASELINE) + f"""
SELECT c.date,
       (SELECT min(s.date) FROM sales s WHERE s.date BETWEEN c.date - {BACK} AND c.date - 1) AS earliest_sale,
       (SELECT count(*) FROM sales s WHERE s.date BETWEEN c.date - {BACK} AND c.date - 1) AS n_sales,
       (SELECT min(p.date) FROM placements_x p WHERE p.date BETWEEN c.date - {BACK} AND c.date - 1) AS earliest_ad,
       (SELECT count(*) FROM placements_x p WHERE p.date BETWEEN c.date - {BACK} AND c.date - 1) AS n_ads,
       (SELECT count(*) FROM nad n WHERE n.date BETWEEN c.date - {BACK} AND c.date - 1) AS n_sales_without_ads,
       (SELECT count(*) FROM baseline b WHERE b.date = c.date) AS n_baseline_skus
FROM cal c""",
    "source_profile": _with() + f"""
SELECT 'sales' AS source, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date
FROM sales WHERE date BETWEEN {READ_START} AND {END}
UNION ALL
SELECT 'placements' AS source, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date
FROM placements WHERE date BETWEEN {READ_START} AND {END}""",
    "stage_counts": _with(ATTRIBUTED, BASELINE, CANDIDATES) + """
SELECT c.date,
       CAST(coalesce(a.n, 0) AS BIGINT) AS n_sales, CAST(coalesce(b.n, 0) AS BIGINT) AS n_ads,
       CAST(coalesce(x.p, 0) AS BIGINT) AS n_pairs, CAST(coalesce(x.w, 0) AS BIGINT) AS n_in_window,
       CAST(coalesce(y.n, 0) AS BIGINT) AS n_winners, g.date IS NOT NULL AS has_baseline
FROM cal c
LEFT JOIN (SELECT date, count(*) AS n FROM sales_run GROUP BY date) a ON a.date = c.date
LEFT JOIN (SELECT date, count(*) AS n FROM pl_run GROUP BY date) b ON b.date = c.date
LEFT JOIN (SELECT date, sum(n_pairs) AS p, sum(n_in_window) AS w FROM cand GROUP BY date) x ON x.date = c.date
LEFT JOIN (SELECT date, count(*) AS n FROM winners GROUP BY date) y ON y.date = c.date
LEFT JOIN gated g ON g.date = c.date""",
    "campaign_id_coverage": _with(ATTRIBUTED) + """
SELECT coalesce(f.id, d.id) AS campaign_id, f.id IS NOT NULL AS in_facts, d.n IS NOT NULL AS in_dimension,
       CAST(coalesce(d.n, 0) AS BIGINT) AS dimension_rows
FROM (SELECT DISTINCT CAST(campaignid AS BIGINT) AS id FROM winners WHERE campaignid IS NOT NULL) f
FULL OUTER JOIN (SELECT CAST(id AS BIGINT) AS id, count(*) AS n FROM campaigns GROUP BY 1) d ON f.id = d.id""",
    "dimension_coverage": _with(ATTRIBUTED) + "\nUNION ALL\n".join(f"""
SELECT '{n}' AS dimension,
       (SELECT count(DISTINCT CAST({key} AS BIGINT)) FROM winners) AS fact_ids,
       (SELECT count(DISTINCT CAST(w.{key} AS BIGINT)) FROM winners w
         WHERE w.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {n} d WHERE CAST(d.id AS BIGINT) = CAST(w.{key} AS BIGINT))) AS unmatched_ids,
       (SELECT count(*) FROM {n}) AS dimension_rows,
       (SELECT count(*) FROM (SELECT id FROM {n} GROUP BY id HAVING count(*) > 1)) AS duplicate_ids""" for n, (key, _) in _ENRICH_COLUMNS.items()),
    "sample_rows": _with(RUN) + """
SELECT order_id, date, sku, location_id, units_sold, sale_amount FROM sales_run ORDER BY date, order_id LIMIT 2""",
    "sale_timestamp_numeric": _with() + """
SELECT order_id, ts_sec AS as_double, ts_sec AS as_decimal, ts_sec AS as_text FROM sales""",
    "attribution_winner_no_placement_id": _with(RUN, PAIRS, WINNERS.replace(
        "placement_id DESC NULLS LAST,", "").replace("adgroupid DESC NULLS LAST,", """adgroupid DESC NULLS LAST,
               aislecategoryid DESC NULLS LAST, retailerorgid DESC NULLS LAST, advertiserorgid DESC NULLS LAST,
               adproduct DESC NULLS LAST, winningcurrencycode DESC NULLS LAST, offercode DESC NULLS LAST,""")) + """
SELECT date, order_id, sku, location_id, begin_sec, end_sec, winningadid, campaignid, offercode FROM winners""",
    "daily_conversions_text_ids": _with(FULL) + "SELECT * REPLACE ('cmp-' || campaign_id AS campaign_id) FROM ("
                                  + DAILY_CONVERSIONS + ")",
}
