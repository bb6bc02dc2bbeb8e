"""Fixed-point prices and bar volumes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1_000_000_000


def _digits(scale: int) -> int:
    digits = len(str(scale)) - 1
    if scale <= 0 or scale != 10**digits:
        raise ValueError("scale must be a positive power of ten")
    return digits


def to_fixed(value: Column, scale: int = SCALE) -> Column:
    """Scaled bigint, rounded half up on the decimal text of the number.

    The cast to a wide decimal keeps the printed digits, and rounding happens
    once, at the target digit. The decimal has room for every value whose scaled
    form fits a bigint; others give NULL.
    """
    digits = _digits(scale)
    exact = value.try_cast(f"decimal(38,{min(38, 19 + digits)})")
    return (F.round(exact, digits) * F.lit(scale)).try_cast("bigint")


def from_fixed(value: Column, scale: int = SCALE) -> Column:
    """Scaled bigint back to double. Decimal division would lose digits here."""
    _digits(scale)
    return value.cast("double") / F.lit(float(scale))


def bar_volume(size: Column) -> Column:
    """Volume of a finished bar: half-even rounding, never negative."""
    return F.greatest(F.lit(0).cast("bigint"), F.bround(size).cast("bigint"))


def truncated_volume(raw: Column, clip: bool = False) -> Column:
    """Volume read back from storage: truncated towards zero; unreadable gives 0."""
    volume = F.coalesce(raw.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.greatest(F.lit(0).cast("bigint"), volume) if clip else volume
