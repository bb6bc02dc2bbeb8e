"""Column builders. Each takes and returns a Column; nothing runs in Python."""

from tidemark.functions.prices import bar_volume, from_fixed, to_fixed, truncated_volume
from tidemark.functions.times import (
    WIDE_CUTOFFS,
    NARROW_CUTOFFS,
    epoch_to_timestamp,
    parse_day_optional,
    parse_iso,
    parse_iso_optional,
    run_label,
    run_stamp,
    width_floor,
)
from tidemark.functions.values import clean_text, finite_or_null, lag_ms, log_ratio, row_json

__all__ = [
    "NARROW_CUTOFFS",
    "WIDE_CUTOFFS",
    "bar_volume",
    "clean_text",
    "epoch_to_timestamp",
    "finite_or_null",
    "from_fixed",
    "lag_ms",
    "log_ratio",
    "parse_day_optional",
    "parse_iso",
    "parse_iso_optional",
    "row_json",
    "run_label",
    "run_stamp",
    "to_fixed",
    "truncated_volume",
    "width_floor",
]
