"""Six left joins that add dimension names to attributed sales.

Each dimension contributes only the columns the output needs, renamed by role
(``name`` -> ``campaign_name`` ...) so no duplicate ``id``/``name`` columns arise.
The planner and AQE choose each join's strategy from bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.contracts import DIMENSION_COLUMNS, require_columns

# Dimension, fact column it joins on, {dimension column: output name}.
DIMENSION_JOINS = (
    ("categories", "aislecategoryid", {"name": "category_name"}),
    ("campaigns", "campaignid", {"name": "campaign_name", "daily_budget": "daily_budget",
                                 "status": "status", "campaign_type": "campaign_type"}),
    ("organizations", "retailerorgid", {"name": "organization_name"}),
    ("locations", "location_id", {"name": "location_name"}),
    ("ad_groups", "adgroupid", {"name": "ad_group_name"}),
    ("ads", "winningadid", {"name": "ad_name"}),
)


def dimension_joins(owners: dict[str, str]) -> tuple:
    """``DIMENSION_JOINS`` for the tables that own the output columns (``contracts.column_owners``)."""
    return tuple((name, key, {"name": columns["name"], **{c: c for c, table in owners.items() if table == name}})
                 for name, key, columns in DIMENSION_JOINS)


def projected_dimension(dim: DataFrame, columns: dict[str, str], id_alias: str) -> DataFrame:
    return dim.select(F.col("id").alias(id_alias), *[F.col(src).alias(dst) for src, dst in columns.items()])


def id_match(fact, fact_type: T.DataType, dim, dim_type: T.DataType):
    """Equality of ids; compared as text where only one side is text."""
    if isinstance(fact_type, T.StringType) != isinstance(dim_type, T.StringType):
        return fact.cast("string") == dim.cast("string")
    return fact == dim


def enrich(facts: DataFrame, dims: dict[str, DataFrame], only: tuple[str, ...] | None = None,
           joins: tuple = DIMENSION_JOINS) -> DataFrame:
    """Left-join the dimensions named in ``only`` (default: all six), in job order.

    No hints: the planner broadcasts a side whose size it knows to be small, and AQE
    one that turns out to be.
    """
    out = facts
    for name, fact_key, columns in (j for j in joins if only is None or j[0] in only):
        require_columns(dims[name], (*DIMENSION_COLUMNS[name], *columns), name)
        key = f"_{name}_id"
        side = projected_dimension(dims[name], columns, key)
        match = id_match(out[fact_key], out.schema[fact_key].dataType, side[key], side.schema[key].dataType)
        out = out.join(side, match, "left").drop(key)
    return out
