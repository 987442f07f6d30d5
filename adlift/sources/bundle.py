"""The set of input tables one run reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# The six dimension tables, in the order the job joins them.
DIMENSIONS = ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")


@dataclass
class Sources:
    """Raw inputs in the job's contract (see ``adlift.contracts``).

    ``sales`` and ``placements`` keep their ``year``/``month``/``day`` partition
    columns so the date-range scan can prune whole directories.
    """

    sales: DataFrame
    placements: DataFrame
    categories: DataFrame
    campaigns: DataFrame
    organizations: DataFrame
    locations: DataFrame
    ad_groups: DataFrame
    ads: DataFrame

    def dimension(self, name: str) -> DataFrame:
        if name not in DIMENSIONS:
            raise KeyError(name)
        return getattr(self, name)
