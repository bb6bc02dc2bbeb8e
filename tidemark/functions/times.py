"""UTC time parsing, epoch units, floors and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of millisecond, microsecond and nanosecond epochs.
# NARROW_CUTOFFS reads present-day milliseconds as microseconds and so on down;
# it is there for data that was produced under those bounds.
WIDE_CUTOFFS = (100_000_000_000, 100_000_000_000_000, 100_000_000_000_000_000)
NARROW_CUTOFFS = (10_000_000_000, 1_000_000_000_000, 1_000_000_000_000_000)


def parse_iso(raw: Column) -> Column:
    """ISO-8601 text with Z, an offset, or neither (then UTC). Bad text raises."""
    return F.to_timestamp(raw)


def parse_iso_optional(raw: Column) -> Column:
    """Same, with NULL for bad or missing text and for a time without a date."""
    return F.when(raw.rlike(r"^\s*[0-9]{4}-"), F.try_to_timestamp(raw))


def parse_day_optional(raw: Column) -> Column:
    """Text of eight digits that reads as a day of 1900 to 2099; NULL for all else."""
    day = raw.rlike("^(19|20)[0-9]{2}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$")
    return F.when(day, F.try_to_timestamp(raw, F.lit("yyyyMMdd")))


def epoch_to_timestamp(raw: Column, cutoffs: tuple[int, int, int] = WIDE_CUTOFFS) -> Column:
    """Number of seconds, milli-, micro- or nanoseconds, told apart by size.

    Works in decimals, so nanosecond epochs keep all their digits; the result
    is cut at microseconds. Text that is no number gives NULL.
    """
    number = raw.try_cast("decimal(29,9)")
    milli, micro, nano = (F.lit(c) for c in cutoffs)
    micros = (
        F.when(number > nano, F.floor(number / F.lit(1_000)))
        .when(number > micro, F.floor(number))
        .when(number > milli, F.floor(number * F.lit(1_000)))
        .otherwise(F.floor(number * F.lit(1_000_000)))
    )
    return F.timestamp_micros(micros.try_cast("bigint"))


def width_floor(ts: Column, width: str = "1 minute") -> Column:
    """Start of the tumbling window that holds the timestamp."""
    return F.window(ts, width).getField("start")


def run_stamp(ts: Column) -> Column:
    """Sortable run id such as 20260409_103000."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def run_label(name: Column) -> Column:
    """Readable form of a run id; anything else is returned unchanged."""
    return F.regexp_replace(
        name,
        r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$",
        "$1-$2-$3  $4:$5:$6 UTC",
    )
