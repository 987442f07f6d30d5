"""Rerun only the days that a change of the inputs reaches.

A day's output depends on its own sales and placements, on the history of the
``lookback_days`` before it, on the dimensions and on the settings. Each written day keeps a
key of these. A backfill over any window computes the keys anew from versions of the inputs
and runs the days whose key differs: a late sale reaches its own day, and the next
``lookback_days`` days only if it changed the kept history of its day.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.config import RunConfig
from adlift.operators.baseline import daily_history
from adlift.operators.normalize import normalize_sales, placement_times
from adlift.plans.calendar import run_calendar
from adlift.plans.daily import Stages, begin_day_between, run, stages
from adlift.sources.bundle import DIMENSIONS, Sources
from adlift.sources.catalog import scan_date_range
from adlift.sources.sink import output_table
from adlift.sources.summary import HistorySummary
from adlift.sources.versions import VERSIONS, combined, content_versions


def _between(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def input_versions(sources: Sources, cfg: RunConfig) -> DataFrame:
    """``date, version`` of sales and placements together, by content, from the first history day to the last run day."""
    s = stages(sources, cfg)
    sales = s.sales.where(F.col("date").between(F.lit(cfg.read_start), F.lit(cfg.end)))
    placements = placement_times(begin_day_between(s._raw_placements, cfg.read_start, cfg.end), s._owned_by("placements"))
    return combined(content_versions(sales), content_versions(placements))


def history_of(sources: Sources, cfg: RunConfig, days: list[dt.date]) -> DataFrame:
    """The histories of just these days; where the day is the stored one, only their folders of sales are read."""
    sales = scan_date_range(sources.sales, cfg.read_start, cfg.end)
    if cfg.sales_date_source == "parts":
        stored = F.col("year").try_cast("int") * 10_000 + F.col("month").try_cast("int") * 100 + F.col("day").try_cast("int")
        sales = sources.sales.where(stored.isin([d.year * 10_000 + d.month * 100 + d.day for d in days]))
    s = stages(sources, cfg.with_(start=min(days) + dt.timedelta(days=1), end=max(cfg.end, max(days) + dt.timedelta(days=1)),
                                  lookback_days=max(cfg.lookback_days, (max(days) - min(days)).days + 1)))
    rows = normalize_sales(sales, cfg, ()).where(F.col("date").isin(days))
    return daily_history(rows, s.ad_keys.where(F.col("date").isin(days)), min(days), max(days), cfg.baseline_rows)


def day_keys(spark: SparkSession, inputs: DataFrame, history: DataFrame, cfg: RunConfig) -> DataFrame:
    """Per run day ``date, own, past``: what its own inputs and its baseline's history looked like.

    ``inputs`` and ``history`` are versions by day; each history day is copied to the run
    days it feeds (at most ``lookback_days``), so tables of days are all that is joined.
    """
    first, last = F.date_add("date", 1), F.date_add("date", cfg.lookback_days)
    fed = history.select(F.explode(F.sequence(first, last)).alias("to"), "date", "version")
    past = fed.groupBy(F.col("to").alias("date")).agg(
        F.sha2(F.sort_array(F.collect_list(F.struct("date", "version"))).cast("string"), 256).alias("past"))
    own = inputs.select("date", F.col("version").alias("own"))
    return run_calendar(spark, cfg).join(own, "date", "left").join(past, "date", "left").select("date", "own", "past")


def affected_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Run days to compute again: ``date, own_changed, past_changed`` where a key differs from before."""
    b = before.select("date", F.col("own").alias("_own"), F.col("past").alias("_past"), F.lit(True).alias("_ran"))
    both = after.join(b, "date", "left")
    new = F.col("_ran").isNull()
    return both.select("date", (new | ~F.col("own").eqNullSafe(F.col("_own"))).alias("own_changed"),
                       (new | ~F.col("past").eqNullSafe(F.col("_past"))).alias("past_changed")).where("own_changed OR past_changed")


def _settings_key(spark: SparkSession, s: Stages, cfg: RunConfig) -> str:
    """What reaches every day alike: the dimensions' contents (one small aggregate) and the settings."""
    parts = None
    for name in DIMENSIONS:
        row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(s.dims[name].columns)]).cast("decimal(20,0)")
        own = s.dims[name].agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h")).select(F.lit(name).alias("d"), "n", "h")
        parts = own if parts is None else parts.unionByName(own)
    dims = sorted((r["d"], r["n"], str(r["h"])) for r in parts.collect())
    knobs = {k: str(v) for k, v in sorted(dataclasses.asdict(cfg).items()) if k not in ("start", "end", "write_mode")}
    return hashlib.sha256(json.dumps([dims, knobs]).encode()).hexdigest()


def contiguous(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Sorted days as ranges (first, last)."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in days:
        if out and d - out[-1][1] == dt.timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def backfill(spark: SparkSession, sources: Sources, cfg: RunConfig, output_path: str, summary_path: str,
             versions: DataFrame | None = None) -> dict:
    """Bring every day of the window up to date; returns what was computed.

    ``versions``: the inputs' versions by day (``date, version``), for example from
    :func:`~adlift.sources.versions.file_versions`; by default the inputs' contents, which reads them.
    The driver holds a few words per day of the window and its history.
    """
    if cfg.write_mode != "overwrite":
        raise ValueError("a backfill replaces days; it cannot append")
    given = (input_versions(sources, cfg) if versions is None else versions).where(
        F.col("date").between(F.lit(cfg.read_start), F.lit(cfg.end))).collect()
    now = {r["date"]: r["version"] for r in given}
    summary = HistorySummary(spark, summary_path)
    past_days = _between(cfg.read_start, cfg.history_end)
    refreshed = summary.refresh(lambda days: history_of(sources, cfg, days), now, past_days, cfg)

    table = output_table(spark, output_path)
    table.recover()
    settings = _settings_key(spark, stages(sources, cfg), cfg)
    after = day_keys(spark, spark.createDataFrame(list(now.items()), VERSIONS),
                     summary.versions(cfg.read_start, cfg.history_end), cfg)
    keys = {r["date"].isoformat(): [r["own"], r["past"]] for r in after.collect()}
    kept = table.info()
    ran = kept.get("days", {}) if kept.get("settings") == settings else {}
    schema = "date date, own string, past string"
    before = spark.createDataFrame([(dt.date.fromisoformat(d), *k) for d, k in ran.items()], schema)
    held = spark.createDataFrame([(dt.date.fromisoformat(d), *k) for d, k in keys.items()], schema)
    todo = sorted(r["date"] for r in affected_days(before, held).collect())
    runs = []
    for first, last in contiguous(todo):
        ran = {**ran, **{d.isoformat(): keys[d.isoformat()] for d in _between(first, last)}}
        part = cfg.with_(start=first, end=last)
        history = summary.read(part.read_start, part.history_end)
        runs.append(run(spark, sources, part, output_path, history, {"settings": settings, "days": ran}))
    return {"days_run": [d.isoformat() for d in todo], "history_days": [d.isoformat() for d in refreshed], "runs": runs}
