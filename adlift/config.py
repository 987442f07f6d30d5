"""Run configuration: the date window and the knobs of the attribution model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


@dataclass(frozen=True)
class RunConfig:
    """One job run.

    ``start``/``end`` are inclusive ``yyyy-MM-dd`` days. Sales and placements are
    read from ``start - lookback_days`` so the first day has its full history.
    """

    start: dt.date
    end: dt.date
    # Baseline history: days D-lookback .. D-1 feed day D.
    lookback_days: int = 60
    # How many of the most recent ad-free sale rows of a SKU form its baseline.
    baseline_rows: int = 3
    # A placement is eligible for a sale when it ended at most this long before it.
    grace_seconds: int = 2 * 3600
    # "parts": sales date from the year/month/day partition columns;
    # "timestamp": sales date from the sale time itself.
    sales_date_source: str = "parts"
    # "epoch": sale time is epoch seconds (text or number); "text": a date-time string.
    sale_time_format: str = "epoch"
    # Refuse to write when a dimension repeats an id (a left join would multiply
    # measures); the job itself does not check, so this is off by default.
    require_unique_dimension_ids: bool = False
    # Output column -> table it is taken from, where more than one table has it
    # (see ``adlift.contracts.column_owners``).
    column_owners: dict[str, str] = field(default_factory=dict)
    # Sink: "overwrite" replaces only the day partitions written (dynamic), "append" adds.
    write_mode: str = "overwrite"

    def __post_init__(self):
        object.__setattr__(self, "start", as_date(self.start))
        object.__setattr__(self, "end", as_date(self.end))
        if self.start > self.end:
            raise ValueError(f"start {self.start} is after end {self.end}")
        if self.lookback_days < 1 or self.baseline_rows < 1 or self.grace_seconds < 0:
            raise ValueError("lookback_days and baseline_rows must be >= 1, grace_seconds >= 0")
        if self.baseline_rows > 1000:
            # Beyond spark.sql.optimizer.windowGroupLimitThreshold Spark drops the map-side
            # top-k that keeps a hot SKU's window small.
            raise ValueError(f"baseline_rows must be <= 1000: {self.baseline_rows}")
        if self.sales_date_source not in ("parts", "timestamp"):
            raise ValueError(f"sales_date_source must be 'parts' or 'timestamp': {self.sales_date_source}")
        if self.sale_time_format not in ("epoch", "text"):
            raise ValueError(f"sale_time_format must be 'epoch' or 'text': {self.sale_time_format}")
        if self.write_mode not in ("overwrite", "append"):
            raise ValueError(f"write_mode must be 'overwrite' or 'append': {self.write_mode}")

    @property
    def read_start(self) -> dt.date:
        """First day read from the sources (history of the first run day)."""
        return self.start - dt.timedelta(days=self.lookback_days)

    @property
    def history_end(self) -> dt.date:
        """Last day that can be history for some run day."""
        return self.end - dt.timedelta(days=1)

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    @property
    def days(self) -> list[dt.date]:
        return [self.start + dt.timedelta(days=i) for i in range(self.n_days)]

    def with_(self, **changes) -> "RunConfig":
        return replace(self, **changes)


# The run window that covers every day of the driver's generated
# tables (events span 2024-01-01 .. 2024-01-30 at every scale factor).
FIXTURE_START = "2024-01-01"
FIXTURE_END = "2024-01-30"


def fixture_config(**changes) -> RunConfig:
    return RunConfig(start=FIXTURE_START, end=FIXTURE_END, **changes)
