"""Sums of doubles that do not depend on the order of their rows.

A value is cut into whole units, billionths and billionths of billionths. Each part is a
``long``, so sums of parts are exact and commute: any partitioning, retry or re-planning
of a run gives the same bits, whatever the size of the total. The parts stay in generated
code (no decimals per row); one decimal is made of them per group.

Values that a whole number of units cannot hold (2^53 and more, infinities, NaN) are
summed apart, as the doubles they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BILLION = 1_000_000_000
LIMIT = float(2 ** 53)
TOTAL = "decimal(38,18)"
_PARTS = ("whole", "nano", "atto", "large")


def part_names(name: str) -> list[str]:
    return [f"{name}_{p}" for p in _PARTS]


def parts(name: str, value: str | Column) -> list[Column]:
    """The parts of one value, as columns ``part_names(name)``. Null gives nulls."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    fits = F.abs(x) < F.lit(LIMIT)  # NaN is above every number
    whole = F.floor(x)
    nanos = (x - whole) * F.lit(float(BILLION))
    nano = F.floor(nanos)
    atto = F.round((nanos - nano) * F.lit(float(BILLION))).cast("long")
    exact = [F.when(fits, c) for c in (whole, nano, atto)]
    return [c.alias(n) for c, n in zip([*exact, F.when(~fits, x)], part_names(name))]


def summed(name: str) -> list[Column]:
    """Aggregates that add the parts of many values."""
    return [F.sum(n).alias(n) for n in part_names(name)]


def _decimal(name: str) -> Column:
    whole, nano, atto, _ = (F.coalesce(F.col(n), F.lit(0)) for n in part_names(name))
    # Parts are never negative except whole ones, so a whole quotient carries.
    carried = lambda c: F.call_function("div", c, F.lit(BILLION))
    nano = nano + carried(atto)
    whole = whole + carried(nano)
    rest = nano % F.lit(BILLION) * F.lit(BILLION) + atto % F.lit(BILLION)
    smallest = F.expr("CAST('0.000000000000000001' AS DECIMAL(18,18))")
    return (whole.cast("decimal(19,0)") + rest.cast("decimal(18,0)") * smallest).cast(TOTAL)


def _none(name: str) -> Column:
    whole, _, _, large = part_names(name)
    return F.col(whole).isNull() & F.col(large).isNull()


def total(name: str) -> Column:
    """The sum, as a decimal: null without values, or where it does not fit."""
    large = F.col(part_names(name)[-1])
    with_large = (_decimal(name).cast("double") + large).try_cast(TOTAL)
    return F.when(_none(name), F.lit(None)).when(large.isNull(), _decimal(name)).otherwise(with_large)


def mean(name: str, count: str | Column) -> Column:
    """The mean of ``count`` values, as a double: null without values."""
    n = F.col(count) if isinstance(count, str) else count
    value = _decimal(name).cast("double") + F.coalesce(F.col(part_names(name)[-1]), F.lit(0.0))
    return F.when(~_none(name), value / n)
