"""Column expressions."""

from .columns import (
    case_when,
    count_when,
    first_item,
    first_map_key,
    first_map_value,
    fixed_size_item,
    is_not_blank,
    keyed_uniform,
    round_columns,
    safe_ratio,
    strip_text,
    value_counts,
)

__all__ = [
    "case_when",
    "count_when",
    "first_item",
    "first_map_key",
    "first_map_value",
    "fixed_size_item",
    "is_not_blank",
    "keyed_uniform",
    "round_columns",
    "safe_ratio",
    "strip_text",
    "value_counts",
]
