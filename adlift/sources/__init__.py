"""Sources (catalog/path scans, JDBC dimensions, the driver-table derivation) and the sink."""

from adlift.sources.bundle import DIMENSIONS, Sources  # noqa: F401
