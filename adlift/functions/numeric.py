"""Numeric expressions: choice structs, clamped increments and output casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_choice(df: DataFrame, name: str) -> Column:
    """A numeric column that may arrive as a ``struct<double, int>`` choice.

    Struct form: the ``double`` member when set, else the ``int`` member as double,
    else null. Plain form: ``try_cast`` to double (bad text gives null, not an error).
    Decided from the schema at plan time; no try/except around analysis.
    """
    field = next(f for f in df.schema.fields if f.name.lower() == name.lower())
    c = F.col(field.name)
    if isinstance(field.dataType, T.StructType):
        members = {f.name.lower(): f.name for f in field.dataType.fields}
        parts = []
        if "double" in members:
            parts.append(c.getField(members["double"]).try_cast("double"))
        if "int" in members:
            parts.append(c.getField(members["int"]).try_cast("double"))
        return F.coalesce(*parts) if parts else F.lit(None).cast("double")
    return c.try_cast("double")


def clamped_increment(actual: str | Column, baseline: str | Column) -> Column:
    """``max(actual - baseline, 0)``; a missing baseline gives 0.

    ``greatest`` skips nulls, so a null difference falls to the 0 literal.
    """
    a = F.col(actual) if isinstance(actual, str) else actual
    b = F.col(baseline) if isinstance(baseline, str) else baseline
    return F.greatest(a - b, F.lit(0.0))


# Fixed value: sums of averaged increments are rounded to this many decimals before
# truncating or rounding to cents, so that thirds add up again: three increments of
# 0.333... are one unit. (Sums themselves are exact, see ``adlift.functions.exact``.)
STABLE_DECIMALS = 6


def truncated_units(total: str | Column) -> Column:
    """Fractional unit sums become int by truncation (2.9 -> 2)."""
    t = F.col(total) if isinstance(total, str) else total
    return F.round(t, STABLE_DECIMALS).try_cast("long").try_cast("int")


def money(total: str | Column) -> Column:
    """Half-up to cents, as decimal(10,2) (null when it does not fit)."""
    t = F.col(total) if isinstance(total, str) else total
    return F.round(F.round(t, STABLE_DECIMALS), 2).try_cast(T.DecimalType(10, 2))
