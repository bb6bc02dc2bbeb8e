"""Feed scores, store freshness, counters, alerts and exact ranks."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions import lag_ms
from tidemark.operators.bars import flag_late
from tidemark.operators.ordinals import BEFORE, CELL_ROWS, number_rows, with_halo
from tidemark.panel import ordered_unique
from tidemark.session import work_dir
from tidemark.sources.files import read_newest_hour

# The kinds of feed errors and the status each one gives.
ERROR_KINDS = ("heartbeat_timeout", "protocol_error", "provider_error", "unexpected_error")
SKIPPED = "skipped_missing_key"


def feed_scores(
    ticks: DataFrame,
    errors: DataFrame,
    universe: Iterable[str],
    *,
    feeds: Sequence[str] = (),
    width: str = "1 minute",
    seconds: float | None = None,
) -> DataFrame:
    """One row per feed: ticks, bars, symbol coverage, late ticks and errors.

    ``seconds`` adds the seconds that a feed was to be observed, and those from its
    first to its last tick.

    ticks (seq, symbol, ts, source), errors (source, kind, seq). Bars are the
    distinct windows of ticks that were in time. Counts are taken per source,
    symbol and bar first, so a busy feed is spread over its bars. ``feeds``
    lists sources to report even if they sent nothing; those were skipped.
    """
    names = ordered_unique(universe)
    by_bar = (
        flag_late(ticks.where(F.col("symbol").isin(list(names))), width)
        .groupBy("source", "symbol", "bar_start")
        .agg(
            F.count(F.lit(1)).alias("_ticks"),
            F.expr("count_if(is_late)").alias("_late"),
            F.min("ts").alias("_first"),
            F.max("ts").alias("_last"),
        )
    )
    by_symbol = by_bar.groupBy("source", "symbol").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_ticks").alias("_ticks"),
        F.sum("_late").alias("_late"),
        F.expr("count_if(_ticks > _late)").alias("_bars"),
    )
    seen = by_symbol.groupBy("source").agg(
        ((F.unix_micros(F.max("_last")) - F.unix_micros(F.min("_first"))) / F.lit(1e6)).alias("_observed"),
        F.sum("_ticks").alias("ticks_received"),
        F.sum("_bars").alias("bars_emitted"),
        F.count(F.lit(1)).alias("symbols_seen"),
        F.sum("_late").alias("late_ticks_dropped"),
    )
    unexpected = F.col("kind").isin("provider_error", "unexpected_error")
    failed = errors.groupBy("source").agg(
        F.expr("count_if(kind = 'heartbeat_timeout')").alias("heartbeat_timeouts"),
        F.expr("count_if(kind = 'protocol_error')").alias("protocol_errors"),
        F.count_if(unexpected).alias("unexpected_errors"),
        F.max_by("kind", "seq").alias("_status"),
    )
    scores = seen.join(failed, "source", "full_outer")
    if feeds:
        listed = ticks.sparkSession.createDataFrame([(f,) for f in feeds], "source string")
        scores = scores.join(listed, "source", "full_outer")
    zero = F.lit(0).cast("bigint")
    counts = (
        "ticks_received",
        "bars_emitted",
        "symbols_seen",
        "late_ticks_dropped",
        "heartbeat_timeouts",
        "protocol_errors",
        "unexpected_errors",
    )
    silent = F.col("ticks_received").isNull() & F.col("_status").isNull()
    filled = scores.select(
        "source",
        F.when(silent, F.lit(SKIPPED)).otherwise(F.coalesce("_status", F.lit("ok"))).alias("status"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
        F.coalesce("_observed", F.lit(0.0)).alias("_observed"),
    )
    timed = [] if seconds is None else [F.lit(float(seconds)).alias("seconds_requested"), F.col("_observed").alias("seconds_observed")]
    return filled.select(
        "source",
        "status",
        "ticks_received",
        "bars_emitted",
        "symbols_seen",
        (F.col("symbols_seen") / F.lit(float(max(1, len(names))))).alias("symbol_coverage_ratio"),
        "late_ticks_dropped",
        (F.col("heartbeat_timeouts") + F.col("protocol_errors") + F.col("unexpected_errors")).alias(
            "errors"
        ),
        "heartbeat_timeouts",
        "protocol_errors",
        "unexpected_errors",
        *timed,
    )


def feed_winner(scores: DataFrame, feeds: Sequence[str] = ()) -> DataFrame:
    """(source): the best feed that was not skipped; no row if there is none.

    Of equal feeds the one listed first in ``feeds`` wins; unlisted ones follow by name.
    """
    listed = F.array_position(F.array(*[F.lit(f) for f in feeds]).cast("array<string>"), F.col("source"))
    return (
        scores.where(F.col("status") != SKIPPED)
        .orderBy(
            F.col("errors").asc(),
            F.col("symbol_coverage_ratio").desc(),
            F.col("ticks_received").desc(),
            F.col("bars_emitted").desc(),
            F.col("late_ticks_dropped").asc(),
            F.when(listed > 0, listed).asc_nulls_last(),
            F.col("source").asc(),
        )
        .limit(1)
        .select("source")
    )


def newest_partition(store: DataFrame) -> DataFrame:
    """The rows of the newest (date, hour) of a partitioned bar store.

    The newest pair comes from the partition values alone, and the filter on it
    prunes the read to one folder.
    """
    if "date" not in store.columns or "hour" not in store.columns:
        return store
    newest = store.agg(F.max(F.struct("date", "hour")).alias("p"))
    return store.where(
        (F.col("date") == newest.select("p.date").scalar())
        & (F.col("hour") == newest.select("p.hour").scalar())
    )


def store_freshness(
    store: DataFrame, reference=None, *, max_gap_s: float = 120.0, reason: str = ""
) -> DataFrame:
    """One row (ok, latest, gap_seconds, note): is the store close to the live feed?

    ``reference`` is the end of the last live bar: a time, a Column without
    references to the store such as a scalar subquery, or None. Bar ends given
    as text are parsed; an empty or unreadable store is not fresh.
    """
    if store.schema["bar_end"].dataType.simpleString() == "string":
        end = F.try_to_timestamp("bar_end")
    else:
        end = F.col("bar_end").cast("timestamp")
    found = newest_partition(store).agg(
        F.max(end).alias("latest"), F.count(F.lit(1)).alias("_rows")
    )
    known = F.lit(reference).cast("timestamp")
    gap = (F.unix_micros(known) - F.unix_micros("latest")) / F.lit(1e6)
    note = (
        F.when(F.col("_rows") == 0, F.lit("store is empty"))
        .when(F.col("latest").isNull(), F.lit("store timestamps are invalid"))
        .when(F.col("gap_seconds").isNull(), F.lit("store is available, nothing to compare with"))
        .otherwise(F.format_string("gap_seconds=%.1f", "gap_seconds"))
    )
    if reason:
        note = F.concat(note, F.lit(f" reason={reason}"))
    return found.withColumn("gap_seconds", gap).select(
        (
            F.col("latest").isNotNull()
            & (F.col("gap_seconds").isNull() | (F.col("gap_seconds") <= max_gap_s))
        ).alias("ok"),
        "latest",
        "gap_seconds",
        note.alias("note"),
    )


def stored_freshness(
    spark: SparkSession, path: str, reference=None, *, max_gap_s: float = 120.0, reason: str = ""
) -> DataFrame:
    """``store_freshness`` of a bar store on disk; only its newest folder is opened.

    A store that is not there or has no folders is not fresh.
    """
    newest = read_newest_hour(spark, path)
    if newest is None:
        newest = spark.createDataFrame([], "bar_end timestamp")
    return store_freshness(newest, reference, max_gap_s=max_gap_s, reason=reason)


def latency_alerts(writes: DataFrame, threshold_ms: float = 100.0) -> DataFrame:
    """Event rows for the bar writes slower than the threshold.

    writes: (symbol, bar_end, write_ms).
    """
    if threshold_ms <= 0:
        raise ValueError("threshold_ms must be > 0")
    return writes.where(F.col("write_ms") > threshold_ms).select(
        F.lit("latency_alert").alias("event"),
        "symbol",
        "bar_end",
        "write_ms",
        F.lit(float(threshold_ms)).alias("threshold_ms"),
    )


def ingest_counters(ticks: DataFrame, bar_log: DataFrame, now, width: str = "1 minute") -> DataFrame:
    """One row: ticks received, ticks dropped late, bars written, last bar end, lag in ms."""
    received = (
        flag_late(ticks, width)
        .groupBy("source", "symbol", "bar_start")
        .agg(F.count(F.lit(1)).alias("_n"), F.expr("count_if(is_late)").alias("_late"))
        .agg(F.sum("_n").alias("ticks_received"), F.sum("_late").alias("late_ticks_dropped"))
    )
    written = bar_log.agg(
        F.count(F.lit(1)).alias("bars_written"), F.max("bar_end").alias("last_bar_end")
    )
    zero = F.lit(0).cast("bigint")
    return written.select(
        F.coalesce(received.select("ticks_received").scalar(), zero).alias("ticks_received"),
        F.coalesce(received.select("late_ticks_dropped").scalar(), zero).alias(
            "late_ticks_dropped"
        ),
        "bars_written",
        "last_bar_end",
        lag_ms(F.lit(now).cast("timestamp"), F.col("last_bar_end")).alias("ingest_lag_ms"),
    )


def write_counters(writes: DataFrame, events: DataFrame, *, size: int = 600) -> DataFrame:
    """One row: last, largest and recent p95 write time in ms, and the number of freezes.

    writes (seq, write_ms), events with ``state``. The p95 is over the last
    ``size`` writes, found by a distributed top-n.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    recent = nearest_rank(writes.orderBy(F.col("seq").desc()).limit(size), "write_ms")
    frozen = events.where(F.col("state") == "frozen").agg(F.count(F.lit(1)))
    return writes.agg(
        F.max_by("write_ms", "seq").alias("last_write_ms"), F.max("write_ms").alias("max_write_ms")
    ).select(
        "last_write_ms",
        "max_write_ms",
        recent.select("write_ms").scalar().alias("p95_write_ms"),
        frozen.scalar().alias("freeze_events"),
    )


#: Buckets that a pass cuts the values around the wanted rank into.
BUCKETS = 4096


def nearest_rank(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    *,
    q: float = 0.95,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(keys, n, value): the exact value at sorted position round((n-1)*q), half to even.

    Equal values are counted before the shuffle. Of many values, passes of a histogram
    narrow down where the wanted rank lies, for each key between the smallest and the
    largest value that are left, until at most ``cell_rows`` of them have to be put in
    order. So nothing depends on the scale of the values. NULL values do not count.
    """
    by = list(keys) or ["_all"]
    rows = (df if keys else df.withColumn("_all", F.lit(0))).where(F.col(value).isNotNull())
    names = ", ".join(by)
    rank = f"cast(bround((n - 1) * {float(q)!r}D) as bigint)"
    counts = rows.groupBy(*by, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    if rows.count() <= cell_rows:
        every = f"sum(_n) over (partition by {names})"
        near = counts.selectExpr(*by, "_value", "_n", f"{every} as n", "0L as _before")
        near = near.withColumn("_rank", F.expr(rank))
    else:
        near = _near_rank(counts, by, rank, cell_rows)
    inside = f"coalesce(sum(_n) over (partition by {names} order by _value {BEFORE}), 0L)"
    return (
        near.withColumn("_at", F.expr(f"_before + {inside}"))
        .where("_at <= _rank and _rank < _at + _n")
        .select(*keys, "n", F.col("_value").alias(value))
    )


def _near_rank(counts: DataFrame, by: list[str], rank: str, cell_rows: int) -> DataFrame:
    """The counted values of each key around its rank, with ``n``, ``_before`` and ``_rank``."""
    spark, names = counts.sparkSession, ", ".join(by)

    def kept(frame: DataFrame, label: str) -> DataFrame:
        path = work_dir(spark, label)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    counts = kept(counts, "rank-counts")
    whole = counts.groupBy(*by).agg(
        F.min("_value").alias("_lo"),
        F.max("_value").alias("_hi"),
        F.sum("_n").alias("n"),
        F.count(F.lit(1)).alias("_values"),
    )
    bounds = kept(whole.withColumns({"_before": F.lit(0).cast("bigint"), "_rank": F.expr(rank)}), "rank-bounds")
    left, idle, turn = None, 0, 0
    while idle < 2:
        most, now = bounds.agg(F.max("_values"), F.sum("_values")).first()
        if most is None or most <= cell_rows:
            break
        idle, left = (idle + 1 if now == left else 0), now
        x, lo, hi = (F.col(c).cast("double") / 2 for c in ("_value", "_lo", "_hi"))
        share = (x - lo) / (hi - lo)
        if turn % 2:  # in turn evenly, and by distance from the smallest value over twelve decades
            share = F.log1p(share * 1e12) / F.log1p(F.lit(1e12))
        bucket = F.when(hi > lo, F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS))).otherwise(0)
        bucket = F.when(F.col("_values") <= cell_rows, 0).otherwise(bucket)
        inside = counts.join(bounds, by).where("_value between _lo and _hi")
        cells = inside.groupBy(*by, "n", "_before", "_rank", bucket.alias("_bucket")).agg(
            F.min("_value").alias("_lo"),
            F.max("_value").alias("_hi"),
            F.sum("_n").alias("_n"),
            F.count(F.lit(1)).alias("_values"),
        )
        ahead = f"coalesce(sum(_n) over (partition by {names} order by _bucket {BEFORE}), 0L)"
        located = cells.withColumn("_before", F.expr(f"_before + {ahead}"))
        located = located.where("_before <= _rank and _rank < _before + _n")
        bounds = kept(located.select(*by, "_lo", "_hi", "n", "_values", "_before", "_rank"), "rank-bounds")
        turn += 1
    near = counts.join(bounds, by).where("_value between _lo and _hi")
    return near.select(*by, "_value", "_n", "n", "_before", "_rank")


def rolling_rank(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: str | Sequence[str],
    *,
    size: int = 600,
    q: float = 0.95,
) -> DataFrame:
    """Add ``rolling``: the nearest-rank quantile of the last ``size`` values of a key.

    Rows are numbered per key and cut into blocks with ``size - 1`` rows repeated in front. A block
    keeps its frame in order: each row puts one value in and takes one out. A NULL value takes a
    place in the frame but is not counted.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    spread = with_halo(number_rows(df, list(keys), order), max(8 * size, 1 << 15), size - 1)
    names = df.columns

    def roll(block: pa.Table) -> pa.Table:
        block = block.sort_by("ord")
        values = block.column(value).to_pylist()
        frame: list = []
        found: list = []
        for i, x in enumerate(values):
            if x is not None:
                insort(frame, x)
            if i >= size and values[i - size] is not None:
                del frame[bisect_left(frame, values[i - size])]
            found.append(frame[round((len(frame) - 1) * q)] if frame else None)
        done = block.append_column("rolling", pa.array(found, block.schema.field(value).type))
        own = pa.compute.equal(done.column("block"), done.column("own"))
        return done.filter(own).select([*names, "rolling"])

    kind = df.schema[value].dataType
    schema = StructType([*df.schema.fields, StructField("rolling", kind)])
    return spread.groupBy(*keys, "block").applyInArrow(roll, schema)
