"""Decoders for JSON tick messages.

Both take a frame with the message text and an arrival number and return
ticks, rejected messages, and status errors, so one bad message does not stop
a batch or stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    WIDE_CUTOFFS,
    clean_text,
    epoch_to_timestamp,
    finite_or_null,
    parse_day_optional,
    parse_iso_optional,
)
from tidemark.panel import ordered_unique

# Field names and fatal statuses of the two message forms.
OBJECT_FIELDS = (
    "symbol string, s string, price string, p string, size string,"
    " timestamp string, t string, status string"
)
OBJECT_FATAL = ("error", "failed", "fail")
ARRAY_FIELDS = (
    "ev string, sym string, p string, s string, t string, status string, message string"
)
ARRAY_FATAL = ("auth_failed", "error", "failed")


def _time(raw: Column, cutoffs: tuple[int, int, int]) -> Column:
    return F.coalesce(parse_day_optional(raw), epoch_to_timestamp(raw, cutoffs), parse_iso_optional(raw))


def _number(raw: Column) -> Column:
    return finite_or_null(F.trim(raw).try_cast("double"))


def _ticks(
    events: DataFrame, universe: Iterable[str], source: str
) -> tuple[DataFrame, DataFrame]:
    """Split (seq, [pos,] symbol, _price, _size, _ts, message) into ticks and rejects."""
    at = [c for c in ("seq", "pos") if c in events.columns]
    mine = events.where(F.col("symbol").isin(list(ordered_unique(universe))))
    readable = F.col("_price").isNotNull() & F.col("_ts").isNotNull()
    ticks = mine.where(readable).select(
        *at,
        "symbol",
        F.col("_price").alias("price"),
        F.coalesce("_size", F.lit(0.0)).alias("size"),
        F.col("_ts").alias("ts"),
        F.lit(source).alias("source"),
    )
    rejects = mine.where(~readable).select(
        *at,
        "symbol",
        F.when(F.col("_price").isNull(), F.lit("price")).otherwise(F.lit("time")).alias("reason"),
        "message",
    )
    return ticks, rejects


def decode_object_feed(
    messages: DataFrame,
    universe: Iterable[str],
    *,
    source: str = "object_feed",
    cutoffs: tuple[int, int, int] = WIDE_CUTOFFS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One JSON object per message (seq, message): ticks, rejects, errors.

    Fields have a long and a short name (symbol/s, price/p, timestamp/t). A
    size that is missing or no number is 0. Messages of symbols outside the
    universe are dropped; a price or time that cannot be read is a reject, and so
    is a message that is null or no JSON object (reason ``message``, no symbol). A
    fatal status gives an error row (seq, source, kind, message).
    """
    # inline keeps the parsed fields as columns, so a message is parsed once
    read = F.from_json("message", OBJECT_FIELDS + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    every = messages.select("seq", "message", F.inline(F.array(read))).withColumn(
        "_broken", F.col("message").isNull() | F.col("_corrupt").isNotNull() | ~F.startswith(F.ltrim("message"), F.lit("{"))
    )
    parsed = every.where("not _broken").withColumn(
        "_fatal", F.coalesce(F.lower("status").isin(*OBJECT_FATAL), F.lit(False))
    )
    errors = parsed.where("_fatal").select(
        "seq", F.lit(source).alias("source"), F.lit("protocol_error").alias("kind"), "message"
    )
    events = parsed.where("not _fatal").select(
        "seq",
        F.trim(F.coalesce(F.nullif("symbol", F.lit("")), "s")).alias("symbol"),
        _number(F.coalesce("price", "p")).alias("_price"),
        _number(F.col("size")).alias("_size"),
        _time(F.coalesce(clean_text(F.col("timestamp")), "t"), cutoffs).alias("_ts"),
        "message",
    )
    ticks, rejects = _ticks(events, universe, source)
    return ticks, rejects.unionByName(_unread(every.where("_broken"))), errors


def _unread(broken: DataFrame) -> DataFrame:
    """Rejects for messages that cannot be parsed at all."""
    return broken.select(
        *[c for c in ("seq", "pos") if c in broken.columns], F.lit(None).cast("string").alias("symbol"), F.lit("message").alias("reason"), "message"
    )


def decode_array_feed(
    messages: DataFrame,
    universe: Iterable[str],
    *,
    source: str = "array_feed",
    cutoffs: tuple[int, int, int] = WIDE_CUTOFFS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A JSON array of events, or one event, per message: ticks, rejects, errors.

    Trades have ``ev = 'T'``; a fatal ``status`` event gives an error row and
    other events are skipped. A message that is null or cannot be parsed to its end
    is one reject (reason ``message``, at position 0), without its readable events.
    Events arrive in the order of (``seq``, ``pos``), the number of the message and the
    position in it; pass ``order=("seq", "pos")`` to what depends on the order.
    """
    text = F.trim("message")
    single = F.when(F.startswith(text, F.lit("[")), text).otherwise(
        F.concat(F.lit("["), text, F.lit("]"))
    )
    read = F.from_json(single, f"array<struct<{_fields(ARRAY_FIELDS)}>>")
    every = messages.select("seq", "message", F.posexplode_outer(read).alias("_i", "e")).withColumn(
        "pos", F.coalesce("_i", F.lit(0))
    )
    empty = F.coalesce(F.regexp_like("message", F.lit(r"^\s*\[\s*\]\s*$")), F.lit(False))
    broken = every.where(F.col("e").isNull() & ~empty)
    events = every.where(F.col("e").isNotNull())
    status = F.col("e.ev") == "status"
    errors = events.where(status & F.lower("e.status").isin(*ARRAY_FATAL)).select(
        "seq",
        "pos",
        F.lit(source).alias("source"),
        F.lit("protocol_error").alias("kind"),
        F.coalesce("e.message", F.lit("")).alias("message"),
    )
    trades = events.where(F.col("e.ev") == "T").select(
        "seq",
        "pos",
        F.trim("e.sym").alias("symbol"),
        _number(F.col("e.p")).alias("_price"),
        _number(F.col("e.s")).alias("_size"),
        _time(F.col("e.t"), cutoffs).alias("_ts"),
        "message",
    )
    ticks, rejects = _ticks(trades, universe, source)
    return ticks, rejects.unionByName(_unread(broken)), errors


def _fields(ddl: str) -> str:
    return ", ".join(": ".join(part.split()) for part in ddl.split(","))
