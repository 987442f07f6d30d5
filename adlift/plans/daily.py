"""The whole job as one Spark plan over every day of the run window.

The job's day loop becomes a ``date`` key: attribution joins on (date, sku,
location), the baseline is computed for all days at once (validity intervals),
the day gate is a semi-join against a table of at most one row per run day, and a
single write replaces the loop's per-day writes. Stage order:

    scan -> normalise -> (history without ads -> baseline by day) and
    (latest placement per key -> winners) -> day gate -> + baseline ->
    + dimensions -> 24-key sums -> partitioned Parquet
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.config import RunConfig
from adlift.contracts import DAILY_CONVERSIONS, OWNED_COLUMNS, OWNER_TABLES, column_owners, schema_mismatches
from adlift.operators.attribution import attribute
from adlift.operators.baseline import baseline_by_day, baseline_from_history, gated_days
from adlift.operators.enrich import dimension_joins, enrich
from adlift.functions.dates import epoch_ms_to_seconds, partition_day_predicate
from adlift.operators.metrics import daily_sums, daily_sums_20key, incremental_rows, sums_by_ids
from adlift.operators.normalize import normalize_placements, normalize_sales, placement_keys, sale_seconds
from adlift.sources.bundle import DIMENSIONS, Sources
from adlift.sources.catalog import empty_ones, scan_date_range
from adlift.sources.sink import by_day, output_table

MS_PER_DAY = 86_400_000


def _epoch_ms(d: dt.date) -> int:
    return (d - dt.date(1970, 1, 1)).days * MS_PER_DAY


def begin_day_between(placements: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Placements whose begin time falls on a UTC day in [start, end].

    An integer ``begintime`` is compared as it is, so Parquet min/max statistics skip
    row groups; any other type through the same conversion that gives the begin day.
    """
    kind = next(f.dataType for f in placements.schema.fields if f.name.lower() == "begintime")
    lo, hi = _epoch_ms(start), _epoch_ms(end + dt.timedelta(days=1))
    if isinstance(kind, T.IntegralType):
        return placements.where((F.col("begintime") >= lo) & (F.col("begintime") < hi))
    sec = epoch_ms_to_seconds("begintime")
    return placements.where((sec >= lo // 1000) & (sec < hi // 1000))


class Stages:
    """Intermediate results of one run, each built on first use (all lazy plans).

    sales           normalised sales, history + run days
    sales_run       normalised sales on run days
    placements_run  exploded placements that begin on run days
    placements_history  exploded placements that begin on history days
    ad_keys         distinct (date, sku, location) with a placement, history days
    winners         sale lines with their credited placement (before the gate)
    baseline        (date, sku) -> averages, run days
    gated           run days that have a baseline
    incremental     gated winners + baseline + clamped increments
    """

    def __init__(self, sources: Sources, cfg: RunConfig, history: DataFrame | None = None):
        self.sources, self.cfg, self.history = sources, cfg, history

    @cached_property
    def _raw_sales(self) -> DataFrame:
        return scan_date_range(self.sources.sales, self.cfg.read_start, self.cfg.end)

    @cached_property
    def _raw_placements(self) -> DataFrame:
        return scan_date_range(self.sources.placements, self.cfg.read_start, self.cfg.end)

    @cached_property
    def owners(self) -> dict[str, str]:
        """The table each output column named without one is taken from."""
        return column_owners({t: getattr(self.sources, t) for t in OWNER_TABLES}, self.cfg.column_owners)

    def _owned_by(self, table: str) -> tuple[str, ...]:
        return tuple(c for c in OWNED_COLUMNS if self.owners[c] == table)

    @cached_property
    def sales(self) -> DataFrame:
        return normalize_sales(self._raw_sales, self.cfg, self._owned_by("sales"))

    @cached_property
    def sales_run(self) -> DataFrame:
        return self._sales_run()

    def _sales_run(self, observed=lambda df: df) -> DataFrame:
        """``observed`` sees the normalised rows before the run days are chosen.

        Where the day is the stored one, only the run days' folders are read at all; so an
        observation, below which no filter can be pushed, costs no pruning.
        """
        if self.cfg.sales_date_source == "parts":
            raw = scan_date_range(self.sources.sales, self.cfg.start, self.cfg.end)
        else:
            raw = self._raw_sales
        rows = observed(normalize_sales(raw, self.cfg, self._owned_by("sales"), ("year", "month", "day", "timestamp")))
        return rows.drop("year", "month", "day", "timestamp").where(
            F.col("date").between(F.lit(self.cfg.start), F.lit(self.cfg.end)))

    @cached_property
    def placements_run(self) -> DataFrame:
        rows = begin_day_between(self._raw_placements, self.cfg.start, self.cfg.end)
        return normalize_placements(rows, self._owned_by("placements"))

    @cached_property
    def placements_history(self) -> DataFrame:
        return normalize_placements(begin_day_between(self._raw_placements, self.cfg.read_start, self.cfg.history_end))

    @cached_property
    def ad_keys(self) -> DataFrame:
        return placement_keys(begin_day_between(self._raw_placements, self.cfg.read_start, self.cfg.history_end))

    @cached_property
    def winners(self) -> DataFrame:
        return attribute(self.sales_run, self.placements_run, self.cfg.grace_seconds)

    @cached_property
    def baseline(self) -> DataFrame:
        if self.history is not None:
            return baseline_from_history(self.history, self.cfg)
        return baseline_by_day(self.sales, self.ad_keys, self.cfg)

    @cached_property
    def gated(self) -> DataFrame:
        return gated_days(self.baseline)

    @cached_property
    def incremental(self) -> DataFrame:
        # The baseline feeds the day gate and the join; both keep its plan as it is, so
        # its shuffle is written once and read twice (ReusedExchange), nothing persisted.
        # The gate table has at most one row per run day: a size bound from the config.
        kept = self.winners.join(F.broadcast(self.gated), "date", "left_semi")
        return incremental_rows(kept, self.baseline)

    @cached_property
    def dims(self) -> dict:
        return {name: self.sources.dimension(name) for name in DIMENSIONS}

    def enriched(self, incremental: DataFrame | None = None) -> DataFrame:
        """Increments summed by ids, with the dimension names of those groups."""
        sums = sums_by_ids(self.incremental if incremental is None else incremental)
        return enrich(sums, self.dims, joins=dimension_joins(self.owners))


def stages(sources: Sources, cfg: RunConfig, history: DataFrame | None = None) -> Stages:
    """``history``: kept rows of the history days (``adlift.sources.summary``) instead of their raw sales."""
    return Stages(sources, cfg, history)


def daily_conversions(sources: Sources, cfg: RunConfig) -> DataFrame:
    """The job's output rows for every day of the run (27 columns)."""
    return daily_sums(stages(sources, cfg).enriched())


def daily_conversions_20key(sources: Sources, cfg: RunConfig) -> DataFrame:
    """P4 in the first form's 20-key grouping, one result per run day."""
    return daily_sums_20key(stages(sources, cfg).enriched())


def run(spark: SparkSession, sources: Sources, cfg: RunConfig, output_path: str,
        history: DataFrame | None = None, info: dict | None = None) -> dict:
    """Plan, guard, write. Returns counts observed during the write.

    Two small jobs go before the one write: the emptiness guard and the repeated dimension
    ids. Everything else that is reported is observed while the write runs; after the
    loss of an executor, tasks that run again may count ``winner_rows`` and
    ``unreadable_sale_times`` twice (not the output's counts, nor any written value).

    Empty sales or placements in the read window (the job's empty-source guard) end the run:
    nothing is computed and, unless appending, the window's old days are cleared. With kept
    ``history`` only the run days' sales are looked at. ``info`` is kept with the output's state.
    """
    s, table = stages(sources, cfg, history), output_table(spark, output_path)
    table.recover()
    # An append leaves the days it has no rows for; every other run replaces its window.
    old = table.days(cfg.days) if cfg.write_mode == "overwrite" else []
    sales = s.sales if history is None else s.sales_run
    empty = empty_ones({"sales": sales, "placements": s._raw_placements})
    if empty:
        if old or info is not None:
            table.replace(None, cfg.days, info=info)
        return {"written": False, "reason": f"no {' and no '.join(empty)} in the read window",
                "days_cleared": [d.isoformat() for d in old]}
    repeated = _repeated_dimension_ids(s.dims)
    if repeated and cfg.require_unique_dimension_ids:
        raise ValueError(f"dimensions with repeated ids (would multiply measures): {repeated}")
    won, sold, out = Observation("winners"), Observation("sales"), Observation("output")
    s.sales_run = s._sales_run(lambda df: df.observe(sold, F.count(F.when(_unreadable(cfg), 1)).alias("unread")))
    observed = s.incremental.observe(won, F.count(F.lit(1)).alias("winner_rows"))
    rows = daily_sums(s.enriched(incremental=observed))
    # Q3: the output must match the declared contract before anything is written.
    mismatches = schema_mismatches(rows, DAILY_CONVERSIONS)
    if mismatches:
        raise ValueError(f"output schema differs from the contract: {mismatches}")
    # Above the rebalance, in the write's own tasks, each of which counts once.
    rows = by_day(rows).observe(
        out, F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("units_sold"), F.lit(0)).alias("units_sold"),
        F.count(F.when(F.col("sales").isNull(), 1)).alias("null_sales"),
        F.count(F.when(F.col("daily_budget").isNull(), 1)).alias("null_daily_budget"))
    written = table.replace(rows, cfg.days, cfg.write_mode, info)
    counts = out.get
    if counts["groups"]:
        seen = {"winner_rows": won.get["winner_rows"], "unreadable_sale_times": sold.get["unread"]}
    else:
        # A plan proven empty while it runs drops its nodes, and what they observed.
        unread = scan_date_range(sources.sales, cfg.start, cfg.end).select(
            sale_seconds(cfg).alias("ts_sec"), "timestamp", "year", "month", "day").where(_unreadable(cfg)).count()
        seen = {"winner_rows": 0, "unreadable_sale_times": unread}
    return {"written": True, **counts, **seen, "repeated_dimension_ids": repeated,
            "days_cleared": [d.isoformat() for d in old if d not in written]}


def _unreadable(cfg: RunConfig):
    """A sale stored in the window whose time is given but cannot be read: it silently loses its ad."""
    return F.col("timestamp").isNotNull() & F.col("ts_sec").isNull() & partition_day_predicate(cfg.start, cfg.end)


def _repeated_dimension_ids(dims: dict) -> dict[str, int]:
    """Per dimension, how many ids occur more than once (one aggregate over all six)."""
    ids = None
    for name, df in dims.items():
        own = df.select(F.lit(name).alias("dimension"), F.col("id").cast("string").alias("id"))
        ids = own if ids is None else ids.unionByName(own)
    repeated = ids.groupBy("dimension", "id").count().where(F.col("count") > 1)
    return {r["dimension"]: r["n"] for r in repeated.groupBy("dimension").agg(F.count(F.lit(1)).alias("n")).collect()}
