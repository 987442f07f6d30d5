"""Date and time expressions.

Times are carried as epoch seconds (``long``) inside the engine: comparisons are
integer comparisons and UTC days come from ``date_from_unix_date``, so the result
does not depend on the session time zone. Text parsing (``sale_time_format="text"``)
is the one place the session zone matters; :func:`adlift.session.configure` pins UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(d: dt.date) -> int:
    """yyyymmdd as an integer, the form the partition predicate compares."""
    return d.year * 10_000 + d.month * 100 + d.day


def partition_day_predicate(start: dt.date, end: dt.date, year="year", month="month", day="day") -> Column:
    """Inclusive day range on year/month/day partition columns.

    Only partition columns appear, so Catalyst turns it into ``PartitionFilters``
    and whole day directories are skipped.
    """
    n = (
        _c(year).try_cast("int") * 10_000
        + _c(month).try_cast("int") * 100
        + _c(day).try_cast("int")
    )
    return n.between(day_number(start), day_number(end))


def date_from_parts(year="year", month="month", day="day") -> Column:
    """A date from year/month/day parts, padded ('07') or not ('7').

    Impossible parts (month 13, February 30) give null instead of failing the job.
    """
    text = F.concat_ws("-", _c(year).cast("string"), _c(month).cast("string"), _c(day).cast("string"))
    return F.try_to_date(text, "yyyy-M-d")


def sales_date_padded(year="sales_year", month="sales_month", day="sales_day") -> Column:
    """The day of the three integer parts; a part that is missing gives null."""
    return date_from_parts(year, month, day)


def epoch_ms_to_seconds(ms: str | Column) -> Column:
    """Epoch milliseconds to whole epoch seconds (sub-seconds dropped)."""
    return F.floor(_c(ms).try_cast("double") / 1000).cast("long")


def epoch_seconds_from_value(v: str | Column) -> Column:
    """Sale time as epoch seconds, given as any number or as text ('1727812800', '1727812800.0').

    Fractions are dropped, as the job's cast drops them; unreadable text gives null.
    """
    c = _c(v)
    return F.coalesce(c.try_cast("long"), c.try_cast("decimal(38,9)").try_cast("long"))


def epoch_seconds_from_text(v: str | Column) -> Column:
    """Sale time given as date-time text (session zone, pinned to UTC).

    A fraction counts as the next whole second: ends are whole seconds, so
    ``end >= ceil(ts) - grace`` is the job's ``end >= ts - grace``.
    """
    micros = F.unix_micros(F.try_to_timestamp(_c(v).cast("string")))
    return F.ceil(micros / F.lit(1_000_000)).cast("long")


def date_from_epoch_seconds(sec: str | Column) -> Column:
    """The UTC day of an epoch-seconds instant."""
    return F.date_from_unix_date(F.floor(_c(sec) / SECONDS_PER_DAY).cast("int"))


def date_from_text_time(v: str | Column) -> Column:
    """The day of a date-time text value."""
    return F.to_date(F.try_to_timestamp(_c(v).cast("string")))


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_to_epoch_seconds(ts: str | Column) -> Column:
    """Whole epoch seconds of a wall-clock (timestamp_ntz) value read as UTC."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(ts).cast("timestamp_ntz"))


def seconds_to_ntz(sec: str | Column) -> Column:
    """Epoch seconds as a UTC wall-clock ``timestamp_ntz`` (for readable output)."""
    return F.timestamp_add("SECOND", _c(sec), F.expr(_EPOCH_NTZ))
