"""Column expressions (JVM-side, code-generated): dates, times, numeric casts."""

from adlift.functions.dates import (  # noqa: F401
    date_from_epoch_seconds,
    date_from_parts,
    date_from_text_time,
    day_number,
    epoch_ms_to_seconds,
    epoch_seconds_from_text,
    epoch_seconds_from_value,
    partition_day_predicate,
    sales_date_padded,
)
from adlift.functions.numeric import (  # noqa: F401
    clamped_increment,
    money,
    resolve_choice,
    truncated_units,
)
