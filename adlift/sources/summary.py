"""P1's kept history: per (sku, day) at most k ad-free sale rows, written once per day.

A day's history depends on that day's sales and placements alone, and k rows of it are all
that any later baseline can use. Kept per day, a run reads its own days of sales and the
kept rows of the ``lookback_days`` before them, instead of those days' raw sales. A day is
computed again only when the version of its inputs differs from the one it was made of.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.config import RunConfig
from adlift.operators.baseline import HISTORY_COLUMNS
from adlift.sources.daytable import DayTable
from adlift.sources.versions import content_versions

PARTS = ("history_year", "history_month", "history_day")


class HistorySummary:
    """The kept history below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, DayTable(spark, path, PARTS)

    @staticmethod
    def _form(cfg: RunConfig) -> list:
        """The settings that a day's history depends on."""
        return [cfg.baseline_rows, cfg.sales_date_source, cfg.sale_time_format]

    def stale(self, versions: dict[dt.date, str], days: list[dt.date], cfg: RunConfig) -> list[dt.date]:
        """Days whose kept history was made of other inputs than ``versions``, or never."""
        kept = self.table.info()
        made = kept.get("made", {}) if kept.get("form") == self._form(cfg) else {}
        return [d for d in days if d.isoformat() not in made or made[d.isoformat()] != versions.get(d)]

    def refresh(self, history_of, versions: dict[dt.date, str], days: list[dt.date], cfg: RunConfig) -> list[dt.date]:
        """Bring ``days`` up to date; returns those that were computed.

        ``history_of(days)``: their :func:`~adlift.operators.baseline.daily_history` rows.
        """
        # A finished commit is what ``stale`` compares with.
        self.table.recover()
        todo = self.stale(versions, days, cfg)
        if not todo:
            return []
        rows = history_of(todo).select(*HISTORY_COLUMNS)
        schema = T.StructType([*rows.drop("date").schema.fields, *[T.StructField(p, T.IntegerType()) for p in PARTS]])
        kept, form = self.table.info(), self._form(cfg)
        usable = kept.get("form") == form and kept.get("schema") == schema.jsonValue()
        # Kept rows of another form or of other types are of no use: their days go with this commit.
        gone = [] if usable else [dt.date.fromisoformat(d) for d in kept.get("made", {})]
        made = {**(kept["made"] if usable else {}), **{d.isoformat(): versions.get(d) for d in todo}}
        parts = [f("date").alias(p) for f, p in zip((F.year, F.month, F.dayofmonth), PARTS)]
        out = rows.select(*[F.col(c) for c in HISTORY_COLUMNS if c != "date"], *parts)
        self.table.replace(out.hint("rebalance", *PARTS), sorted({*todo, *gone}),
                           info={"form": form, "schema": schema.jsonValue(), "made": made})
        return todo

    def read(self, start: dt.date, end: dt.date) -> DataFrame:
        """The kept rows of [start, end], as :func:`daily_history` gives them."""
        schema = T.StructType.fromJson(self.table.info()["schema"])
        y, m, d = PARTS
        return self.table.read(schema, start, end).withColumn("date", F.make_date(y, m, d)).select(*HISTORY_COLUMNS)

    def versions(self, start: dt.date, end: dt.date) -> DataFrame:
        """Per day, a version of the kept rows themselves: inputs may change and leave them as they are."""
        return content_versions(self.read(start, end))
