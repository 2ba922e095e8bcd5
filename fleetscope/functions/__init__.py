"""Column expressions (built-in Spark functions only, so they stay in codegen)."""

from fleetscope.functions.expr import (  # noqa: F401
    any_column_contains,
    blank_to_zero,
    clean_plate,
    epoch_seconds,
    format_time,
    parse_time_literal,
    row_text,
    same_day,
    seconds_between,
    text_of,
)
