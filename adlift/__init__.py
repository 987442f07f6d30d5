"""adlift: daily time-based ad attribution and incremental lift on Spark.

Public entry points:

* :class:`adlift.config.RunConfig` - the run window and attribution knobs.
* :func:`adlift.plans.daily.daily_conversions` - the whole job as one lazy plan.
* :func:`adlift.plans.daily.run` - plan plus the partitioned Parquet write.
"""

from adlift.config import RunConfig

__all__ = ["RunConfig"]
