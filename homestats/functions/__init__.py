"""Column-level building blocks (coercion, flags, month keys, rounding)."""

from homestats.functions.coerce import (  # noqa: F401
    as_date,
    as_number,
    as_timestamp,
    flag,
    has,
    month_key,
    pct,
    round4,
    round_half_even,
)
