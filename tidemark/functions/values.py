"""Small value helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or_null(value: Column) -> Column:
    """NaN and infinities become NULL; the engine never lets them through."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(~F.isnan(value) & ~infinite, value)


def log_ratio(current: Column, previous: Column) -> Column:
    """ln(current / previous), NULL wherever that is undefined."""
    return F.ln(F.try_divide(current, previous))


def clean_text(raw: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(raw), F.lit(""))


def lag_ms(now: Column, then: Column) -> Column:
    """Milliseconds from then to now, at least zero."""
    micros = F.unix_micros(now) - F.unix_micros(then)
    return F.greatest(F.lit(0.0), micros / F.lit(1000.0))


def row_json(columns: Sequence[str]) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))
