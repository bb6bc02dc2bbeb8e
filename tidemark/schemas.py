"""Row types shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRICE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
    ]
)

TICK = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("source", T.StringType()),
    ]
)

BAR = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("bar_start", T.TimestampType()),
        T.StructField("bar_end", T.TimestampType()),
        T.StructField("open_fixed", T.LongType()),
        T.StructField("high_fixed", T.LongType()),
        T.StructField("low_fixed", T.LongType()),
        T.StructField("close_fixed", T.LongType()),
        T.StructField("volume", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("bar_end", T.TimestampType()),
        T.StructField("write_ms", T.DoubleType()),
        T.StructField("threshold_ms", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("last_bar_end", T.TimestampType()),
        T.StructField("type2_ok", T.BooleanType()),
        T.StructField("type2_note", T.StringType()),
        T.StructField("type2_checked_at", T.TimestampType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("after_bar_end", T.TimestampType()),
    ]
)


def require_time(df: DataFrame, column: str) -> None:
    """Raise TypeError unless the column is a date or timestamp."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise TypeError(f"{column} must be a timestamp or date, got {kind.simpleString()}")


def with_utc(df: DataFrame) -> DataFrame:
    """Cast zone-less timestamps to timestamps; the session zone is UTC."""
    naive = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: df[name].cast("timestamp") for name in naive}) if naive else df
