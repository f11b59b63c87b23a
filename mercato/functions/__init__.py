"""Scalar column functions (JVM-side expressions only)."""

from mercato.functions.columns import (  # noqa: F401
    clip,
    col_,
    count_when,
    entity_key,
    equal_width_bin,
    missing,
    nan_to_null,
    right_closed_bin,
    safe_div,
    short_id,
    weight_of,
)
