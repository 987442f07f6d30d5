"""Registered queries: one per operator key of the inventory, over the driver's tables.

Each Spark query takes (spark, sf_dir) and returns a DataFrame; ``ORACLE`` holds the
same question in DuckDB SQL, written the way the job states it (pairs then rank,
a day-by-day ranked baseline), so it checks the engine's set-based rewrites.

Every query covers the whole run window 2024-01-01 .. 2024-01-30 (all days of the
generated tables) with a 60-day lookback. Computed doubles are rounded to 6
decimals on both sides so float summation order cannot change a hash.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.config import RunConfig, fixture_config
from adlift.functions.dates import (
    date_from_epoch_seconds,
    date_from_parts,
    date_from_text_time,
    epoch_ms_to_seconds,
    epoch_seconds_from_text,
    epoch_seconds_from_value,
    sales_date_padded,
    seconds_to_ntz,
)
from adlift.functions.numeric import resolve_choice
from adlift.operators import attribution, baseline, quality
from adlift.operators.enrich import DIMENSION_JOINS, enrich
from adlift.operators.metrics import daily_sums, daily_sums_20key
from adlift.operators.normalize import (
    explode_tracked_skus,
    normalize_placements,
    normalize_sales,
    placement_keys,
    placement_times,
)
from adlift.plans import backfill, daily
from adlift.plans.calendar import run_calendar_with_inputs
from adlift.session import checkpoint_dir, configure
from adlift.sources import fixtures
from adlift.sources.catalog import scan_date_range
from adlift.sources.layout import BucketedFacts, write_bucketed
from adlift.sources.sink import read_daily_conversions, write_daily_conversions
from adlift.sources.summary import HistorySummary
from adlift.sources.versions import content_versions

R6 = 6
# The window of the scan query, a two-week slice of the run.
SCAN_START, SCAN_END = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
# The day of the single-day baseline query: the last run day, whose 60-day
# history covers every earlier day of the data.
SINGLE_DAY = dt.date(2024, 1, 30)
# The day that the rerun queries write again.
EMPTIED_DAY = dt.date(2024, 1, 15)


def _cfg() -> RunConfig:
    return fixture_config()


def _setup(spark: SparkSession, sf_dir: str):
    """The inputs over ``sf_dir``, loaded once per session (lazy plans, not data)."""
    configure(spark)
    loaded = spark.__dict__.setdefault("_adlift_sources", {})
    if sf_dir not in loaded:
        loaded[sf_dir] = fixtures.load(spark, sf_dir)
    return loaded[sf_dir]


def _stages(spark, sf_dir) -> daily.Stages:
    """One run's stages over ``sf_dir``, built once per session and shared by the
    reports (lazy plans, not data)."""
    src = _setup(spark, sf_dir)
    built = spark.__dict__.setdefault("_adlift_stages", {})
    if sf_dir not in built:
        built[sf_dir] = daily.stages(src, _cfg())
    return built[sf_dir]


def _r(c: str) -> F.Column:
    return F.round(c, R6).alias(c)


# ---- sources and scans -------------------------------------------------------

def q_scan_date_range(spark, sf_dir):
    src = _setup(spark, sf_dir)
    rows = scan_date_range(src.sales, SCAN_START, SCAN_END)
    return rows.select("order_id", "sku", "location_id", "units_sold", "sale_amount", "timestamp",
                       F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                       F.col("day").cast("int").alias("day"))


def q_lookback_window(spark, sf_dir):
    """What a run of SCAN_START..SCAN_END with a lookback of a week reads of each source, by stored day."""
    src, cfg = _setup(spark, sf_dir), RunConfig(start=SCAN_START, end=SCAN_END, lookback_days=7)
    st = daily.stages(src, cfg)
    rows = [df.select(F.lit(name).alias("source"), date_from_parts("year", "month", "day").alias("date"))
            for name, df in (("sales", st._raw_sales), ("placements", st._raw_placements))]
    return rows[0].unionByName(rows[1]).groupBy("source", "date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_run_calendar(spark, sf_dir):
    s = _stages(spark, sf_dir)
    placements = placement_times(scan_date_range(s.sources.placements, s.cfg.start, s.cfg.end))
    return run_calendar_with_inputs(spark, s.cfg, s.sales_run, placements)


def _dim_query(name):
    def q(spark, sf_dir):
        return getattr(_setup(spark, sf_dir), name)
    q.__name__ = f"q_dim_{name}"
    return q


def q_sink_roundtrip(spark, sf_dir):
    out = daily_sums(_stages(spark, sf_dir).enriched())
    path = _output_folder(spark, "sink")
    write_daily_conversions(out, path, _cfg().days)
    # Writing the same range again replaces those day partitions, adds nothing.
    write_daily_conversions(out, path, _cfg().days)
    return read_daily_conversions(spark, path)


# ---- scalar functions ----------------------------------------------------------

def q_sales_date_from_parts(spark, sf_dir):
    s = _setup(spark, sf_dir).sales
    y, m, d = (F.col(c).cast("string") for c in ("year", "month", "day"))
    return s.select("order_id", date_from_parts(y, m, d).alias("date"),
                    y.try_cast("int").alias("sales_year"), m.try_cast("int").alias("sales_month"),
                    d.try_cast("int").alias("sales_day"))


def _text_time(s: DataFrame) -> DataFrame:
    # The first form of the job stores sale time as date-time text.
    return s.withColumn("timestamp", F.date_format(F.timestamp_seconds(epoch_seconds_from_value("timestamp")),
                                                   "yyyy-MM-dd HH:mm:ss"))


def q_sales_date_from_ts(spark, sf_dir):
    s = _text_time(_setup(spark, sf_dir).sales)
    return s.select("order_id", date_from_text_time("timestamp").alias("date"))


def q_sale_timestamp_epoch(spark, sf_dir):
    s = _setup(spark, sf_dir).sales
    sec = epoch_seconds_from_value("timestamp")
    return s.select("order_id", sec.alias("ts_sec"), seconds_to_ntz(sec).alias("sale_time"))


def q_sale_timestamp_text(spark, sf_dir):
    s = _text_time(_setup(spark, sf_dir).sales)
    return s.select("order_id", epoch_seconds_from_text("timestamp").alias("ts_sec"))


def q_sales_date_padded(spark, sf_dir):
    s = _setup(spark, sf_dir).sales
    return s.select("order_id", sales_date_padded("year", "month", "day").alias("sales_date"))


def q_placement_date(spark, sf_dir):
    p = placement_times(_setup(spark, sf_dir).placements)
    return p.select("placement_id", "date")


def q_placement_interval(spark, sf_dir):
    p = placement_times(_setup(spark, sf_dir).placements)
    return p.select("placement_id", "begin_sec", "end_sec",
                    seconds_to_ntz("begin_sec").alias("begin_time"), seconds_to_ntz("end_sec").alias("end_time"))


def q_placement_partitions(spark, sf_dir):
    """Partition parts under their ``placement_`` names, the sales parts' names free."""
    p = placement_times(_setup(spark, sf_dir).placements)
    return p.select("placement_id", *[F.col(f"placement_{c}").cast("int").alias(f"placement_{c}") for c in ("year", "month", "day")])


def q_resolve_choice(spark, sf_dir):
    p = _setup(spark, sf_dir).placements
    # The choice form: even ids carry the double member, odd ids the int member.
    choice = F.struct(
        F.when(F.col("placement_id") % 2 == 0, F.col("winningbidamount")).alias("double"),
        F.when(F.col("placement_id") % 2 == 1, F.floor("winningbidamount").cast("int")).alias("int"),
    )
    p = p.withColumn("bid_choice", choice)
    return p.select("placement_id", resolve_choice(p, "winningbidamount").alias("winningbidamount"),
                    resolve_choice(p, "winningbidprice").alias("winningbidprice"),
                    resolve_choice(p, "bid_choice").alias("bid_choice"))


def q_explode_tracked_skus(spark, sf_dir):
    p = explode_tracked_skus(placement_times(_setup(spark, sf_dir).placements))
    return p.select("placement_id", "date", "sku", "location_id")


# ---- attribution -------------------------------------------------------------

def q_attribution_candidates(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return attribution.candidate_counts(s.sales_run, s.placements_run, s.cfg.grace_seconds)


def q_attribution_winner(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return s.winners.select("date", "order_id", "sku", "location_id", "ts_sec", "placement_id",
                            "begin_sec", "end_sec")


# ---- baseline ----------------------------------------------------------------

def q_sales_without_ads(spark, sf_dir):
    s = _stages(spark, sf_dir)
    rows = baseline.sales_without_ads(s.sales, s.ad_keys, s.cfg.read_start, s.cfg.history_end)
    return rows.select("date", "order_id", "sku", "location_id", "ts_sec", "units_sold", "sale_amount")


def q_baseline_single_day(spark, sf_dir):
    src = _setup(spark, sf_dir)
    cfg = _cfg()
    lo, hi = SINGLE_DAY - dt.timedelta(days=cfg.lookback_days), SINGLE_DAY - dt.timedelta(days=1)
    sales = normalize_sales(scan_date_range(src.sales, lo, hi), cfg)
    keys = placement_keys(daily.begin_day_between(scan_date_range(src.placements, lo, hi), lo, hi))
    b = baseline.baseline_single_day(sales, keys, SINGLE_DAY, cfg)
    return b.select("sku", _r("avg_units_sold_no_ad_traffic"), _r("avg_sales_no_ad_traffic"))


def q_baseline_by_day(spark, sf_dir):
    b = _stages(spark, sf_dir).baseline
    return b.select("date", "sku", _r("avg_units_sold_no_ad_traffic"), _r("avg_sales_no_ad_traffic"))


def q_gated_days(spark, sf_dir):
    return _stages(spark, sf_dir).gated


# ---- enrichment, increments, sums ----------------------------------------------

_WINNER_KEYS = ("date", "order_id", "sku", "location_id")


def _enrich_query(dim_names: tuple[str, ...]):
    cols = [c for name, _, m in DIMENSION_JOINS if name in dim_names for c in m.values()]

    def q(spark, sf_dir):
        s = _stages(spark, sf_dir)
        return enrich(s.winners, s.dims, only=dim_names).select(*_WINNER_KEYS, *cols)
    return q


def q_incremental_rows(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return s.incremental.select(*_WINNER_KEYS, "units_sold", "sale_amount",
                                _r("avg_units_sold_no_ad_traffic"), _r("avg_sales_no_ad_traffic"),
                                _r("incremental_units_sold"), _r("incremental_sales"))


def q_daily_conversions(spark, sf_dir):
    return daily_sums(_stages(spark, sf_dir).enriched())


def q_daily_conversions_20key(spark, sf_dir):
    return daily_sums_20key(_stages(spark, sf_dir).enriched())


def q_sale_timestamp_numeric(spark, sf_dir):
    s = _setup(spark, sf_dir).sales
    as_long = F.col("timestamp").cast("long")
    forms = {"as_double": as_long.cast("double"), "as_decimal": as_long.cast("decimal(20,3)"),
             "as_text": F.concat(as_long.cast("string"), F.lit(".0"))}
    s = s.select("order_id", *[c.alias(n) for n, c in forms.items()])
    return s.select("order_id", *[epoch_seconds_from_value(n).alias(n) for n in forms])


def q_attribution_winner_no_placement_id(spark, sf_dir):
    src, cfg = _setup(spark, sf_dir), _cfg()
    bare = dataclasses.replace(src, placements=src.placements.drop("placement_id"))
    return daily.stages(bare, cfg).winners.select("date", "order_id", "sku", "location_id", "begin_sec", "end_sec",
                                                  "winningadid", "campaignid", "offercode")


def q_daily_conversions_text_ids(spark, sf_dir):
    src = _setup(spark, sf_dir)
    named = lambda df, c: df.withColumn(c, F.concat(F.lit("cmp-"), F.col(c).cast("string")))
    text = dataclasses.replace(src, placements=named(src.placements, "campaignid"), campaigns=named(src.campaigns, "id"))
    return daily.daily_conversions(text, _cfg())


def q_daily_conversions_owner(spark, sf_dir):
    src = _setup(spark, sf_dir)
    seat = lambda prefix: F.concat(F.lit(prefix), F.col("name"))
    moved = dataclasses.replace(
        src, sales=src.sales.drop("state", "city"),
        organizations=src.organizations.withColumns({"state": seat("State of "), "city": seat("City of ")}))
    return daily.daily_conversions(moved, _cfg())


def _output_folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/adlift-{name}-{uuid.uuid4().hex}"


def q_sink_rerun_timestamp_form(spark, sf_dir):
    """Every fifth sale is stored a day before its time; its output stays on its own day."""
    src = _setup(spark, sf_dir)
    stored = F.date_sub(date_from_parts("year", "month", "day"), F.when(F.col("order_id") % 5 == 0, 1).otherwise(0))
    late = src.sales.withColumn("_stored", stored).withColumns({
        "year": F.year("_stored"), "month": F.month("_stored"), "day": F.dayofmonth("_stored")}).drop("_stored")
    src = dataclasses.replace(src, sales=late)
    cfg = _cfg().with_(sales_date_source="timestamp")
    path = _output_folder(spark, "rerun-timestamp")
    daily.run(spark, src, cfg, path)
    daily.run(spark, src, cfg.with_(start=EMPTIED_DAY, end=EMPTIED_DAY), path)
    return read_daily_conversions(spark, path)


def q_sink_rerun_emptied_day(spark, sf_dir):
    """A rerun of two days, one of which has lost its placements."""
    src, cfg = _setup(spark, sf_dir), _cfg()
    path = _output_folder(spark, "rerun-emptied")
    daily.run(spark, src, cfg, path)
    begin = date_from_epoch_seconds(epoch_ms_to_seconds("begintime"))
    lost = dataclasses.replace(src, placements=src.placements.where(begin != F.lit(EMPTIED_DAY)))
    daily.run(spark, lost, cfg.with_(start=EMPTIED_DAY - dt.timedelta(days=1), end=EMPTIED_DAY), path)
    return read_daily_conversions(spark, path)


def q_empty_window(spark, sf_dir):
    """A rerun of two days whose sources have become empty: its days go, all others stay."""
    src, cfg = _setup(spark, sf_dir), _cfg()
    path = _output_folder(spark, "rerun-empty")
    daily.run(spark, src, cfg, path)
    none = dataclasses.replace(src, placements=src.placements.where("placement_id IS NULL"))
    daily.run(spark, none, cfg.with_(start=EMPTIED_DAY - dt.timedelta(days=1), end=EMPTIED_DAY), path)
    return read_daily_conversions(spark, path)


# ---- kept history and backfill ------------------------------------------------

# The state of the inputs before the change that these queries follow: some sales
# from LATE_FROM on had not arrived, nor one location's placements of LATE_FROM. A short lookback
# lets the change's reach end within the run.
LATE_FROM, LATE_LOCATION, SHORT_LOOKBACK = dt.date(2024, 1, 18), 3, 4


def _earlier(src):
    stored = date_from_parts("year", "month", "day")
    begin = date_from_epoch_seconds(epoch_ms_to_seconds("begintime"))
    late_sale = (F.col("order_id") % 50 == 7) & stored.isin([LATE_FROM, LATE_FROM + dt.timedelta(days=9)])
    late_ad = (F.col("locationid") == LATE_LOCATION) & (begin == F.lit(LATE_FROM))
    return dataclasses.replace(src, sales=src.sales.where(~late_sale), placements=src.placements.where(~late_ad))


def q_baseline_from_summary(spark, sf_dir):
    """The history kept before the change, brought up to date for the changed days, and read."""
    src, cfg = _setup(spark, sf_dir), _cfg()
    kept = HistorySummary(spark, _output_folder(spark, "history"))
    days = [cfg.read_start + dt.timedelta(days=i) for i in range((cfg.history_end - cfg.read_start).days + 1)]
    for state in (_earlier(src), src):
        versions = {r["date"]: r["version"] for r in backfill.input_versions(state, cfg).collect()}
        kept.refresh(lambda todo, state=state: backfill.history_of(state, cfg, todo), versions, days, cfg)
    b = daily.stages(src, cfg, kept.read(cfg.read_start, cfg.history_end)).baseline
    return b.select("date", "sku", _r("avg_units_sold_no_ad_traffic"), _r("avg_sales_no_ad_traffic"))


def q_affected_days(spark, sf_dir):
    """Run days that the change reaches, by their own inputs or by the history of their baseline."""
    src, cfg = _setup(spark, sf_dir), _cfg().with_(lookback_days=SHORT_LOOKBACK)

    def keys(state):
        s = daily.stages(state, cfg)
        hist = baseline.daily_history(s.sales, s.ad_keys, cfg.read_start, cfg.history_end, cfg.baseline_rows)
        return backfill.day_keys(spark, backfill.input_versions(state, cfg), content_versions(hist), cfg)

    return backfill.affected_days(keys(_earlier(src)), keys(src))


def q_backfill_output(spark, sf_dir):
    """The output written before the change and brought up to date by the affected days alone."""
    src, cfg = _setup(spark, sf_dir), _cfg()
    out, kept = _output_folder(spark, "backfill"), _output_folder(spark, "backfill-history")
    for state in (_earlier(src), src):
        backfill.backfill(spark, state, cfg, out, kept)
    return read_daily_conversions(spark, out)


# ---- bucketed layout -----------------------------------------------------------

def _bucketed(spark, sf_dir) -> BucketedFacts:
    """Both facts of the run's days and their history, written bucketed."""
    s = _stages(spark, sf_dir)
    placements = normalize_placements(daily.begin_day_between(s._raw_placements, s.cfg.read_start, s.cfg.end))
    return write_bucketed(spark, s.sales, placements, f"adlift_{uuid.uuid4().hex}", _output_folder(spark, "bucketed"), 8)


def q_attribution_winner_bucketed(spark, sf_dir):
    cfg = _cfg()
    return _bucketed(spark, sf_dir).winners(cfg.start, cfg.end, cfg.grace_seconds).select(
        "date", "order_id", "sku", "location_id", "ts_sec", "placement_id", "begin_sec", "end_sec")


def q_sales_without_ads_bucketed(spark, sf_dir):
    cfg = _cfg()
    return _bucketed(spark, sf_dir).sales_without_ads(cfg.read_start, cfg.history_end).select(
        "date", "order_id", "sku", "location_id", "ts_sec", "units_sold", "sale_amount")


# ---- quality reports -----------------------------------------------------------

def q_source_profile(spark, sf_dir):
    s = _stages(spark, sf_dir)
    src = _setup(spark, sf_dir)
    placements = placement_times(scan_date_range(src.placements, s.cfg.read_start, s.cfg.end))
    return quality.source_profile({"sales": s.sales, "placements": placements})


def q_stage_counts(spark, sf_dir):
    s = _stages(spark, sf_dir)
    funnel = attribution.funnel_by_day(s.sales_run, s.placements_run, s.cfg.grace_seconds)
    return quality.stage_counts(spark, s.cfg, funnel, s.winners, s.gated)


def q_baseline_profile(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return quality.baseline_profile(spark, s.cfg, s.sales, s.placements_history, s.baseline)


def q_campaign_id_coverage(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return quality.id_coverage(s.winners.select(F.col("campaignid").alias("campaign_id")),
                               s.dims["campaigns"], "campaign_id")


def q_dimension_coverage(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return quality.dimension_coverage(s.winners, s.dims, DIMENSION_JOINS)


def q_sample_rows(spark, sf_dir):
    s = _stages(spark, sf_dir)
    return quality.sample_rows(
        s.sales_run.select("order_id", "date", "sku", "location_id", "units_sold", "sale_amount"),
        ["date", "order_id"], 2)


def q_show_rows(spark, sf_dir):
    """L2: five rows of the chosen columns."""
    s = _setup(spark, sf_dir).sales
    shown = s.select("order_id", *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day")])
    return quality.sample_rows(shown, ["order_id"], 5)


QUERIES = {
    "scan_date_range": q_scan_date_range,
    "run_calendar": q_run_calendar,
    **{f"dim_{n}": _dim_query(n) for n in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")},
    "sink_roundtrip": q_sink_roundtrip,
    "sales_date_from_parts": q_sales_date_from_parts,
    "sales_date_from_ts": q_sales_date_from_ts,
    "placement_date": q_placement_date,
    "resolve_choice": q_resolve_choice,
    "explode_tracked_skus": q_explode_tracked_skus,
    "sale_timestamp_epoch": q_sale_timestamp_epoch,
    "sale_timestamp_text": q_sale_timestamp_text,
    "placement_interval": q_placement_interval,
    "sales_date_padded": q_sales_date_padded,
    "attribution_candidates": q_attribution_candidates,
    "attribution_winner": q_attribution_winner,
    "sales_without_ads": q_sales_without_ads,
    "baseline_single_day": q_baseline_single_day,
    "baseline_by_day": q_baseline_by_day,
    "gated_days": q_gated_days,
    **{f"enrich_{name}": _enrich_query((name,)) for name, _, _ in DIMENSION_JOINS},
    "enrich_dims": _enrich_query(tuple(name for name, _, _ in DIMENSION_JOINS)),
    "incremental_rows": q_incremental_rows,
    "daily_conversions": q_daily_conversions,
    "daily_conversions_20key": q_daily_conversions_20key,
    "sale_timestamp_numeric": q_sale_timestamp_numeric,
    "attribution_winner_no_placement_id": q_attribution_winner_no_placement_id,
    "daily_conversions_text_ids": q_daily_conversions_text_ids,
    "daily_conversions_owner": q_daily_conversions_owner,
    "sink_rerun_timestamp_form": q_sink_rerun_timestamp_form,
    "sink_rerun_emptied_day": q_sink_rerun_emptied_day,
    "empty_window": q_empty_window,
    "baseline_from_summary": q_baseline_from_summary,
    "affected_days": q_affected_days,
    "backfill_output": q_backfill_output,
    "attribution_winner_bucketed": q_attribution_winner_bucketed,
    "sales_without_ads_bucketed": q_sales_without_ads_bucketed,
    "placement_partitions": q_placement_partitions,
    "lookback_window": q_lookback_window,
    "show_rows": q_show_rows,
    "source_profile": q_source_profile,
    "baseline_profile": q_baseline_profile,
    "stage_counts": q_stage_counts,
    "campaign_id_coverage": q_campaign_id_coverage,
    "dimension_coverage": q_dimension_coverage,
    "sample_rows": q_sample_rows,
}
