"""OHLCV bars from ticks, late ticks, retention, gaps and backfill.

Ticks carry ``seq``, a unique arrival number, or several columns that are unique
together. They order everything that the order of arrival decides: open, close
and lateness.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bar_volume, to_fixed, truncated_volume, width_floor
from tidemark.functions.prices import SCALE
from tidemark.operators.ordinals import BEFORE, CELL_ROWS, running_max
from tidemark.panel import Panel, densify, ordered_unique

def _placed(order: Sequence[str]):
    """The order of arrival as one value."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def flag_late(
    ticks: DataFrame,
    width: str = "1 minute",
    *,
    keys: Sequence[str] = ("source", "symbol"),
    order: Sequence[str] = ("seq",),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``bar_start`` and ``is_late``: the tick's bar closed before it arrived.

    A tick is late when an earlier arrival of its symbol, from the same source,
    opened a later bar. That is a running maximum over the arrival order, which
    may be numbers of any kind (counters, epochs) in one column or several.
    """
    placed = ticks.withColumn("bar_start", width_floor(F.col("ts"), width))
    return (
        running_max(placed, keys, order, "bar_start", "_open", cell_rows)
        .withColumn("is_late", F.expr("coalesce(bar_start < _open, false)"))
        .drop("_open")
    )


def late_ticks(ticks: DataFrame, width: str = "1 minute", *, order: Sequence[str] = ("seq",)) -> DataFrame:
    """(source, symbol, ticks, late_ticks)."""
    return (
        flag_late(ticks, width, order=order)
        .groupBy("source", "symbol")
        .agg(
            F.count(F.lit(1)).alias("ticks"),
            F.expr("count_if(is_late)").alias("late_ticks"),
        )
    )


def bars(
    ticks: DataFrame,
    width: str = "1 minute",
    *,
    drop_late: bool = True,
    scale: int = SCALE,
    floats: bool = False,
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """One OHLCV bar per symbol, source and window, prices as scaled bigints.

    Open and close follow the arrival order, of which the last tick's is kept in the
    same columns; the volume is the rounded sum of sizes. ``floats`` adds open, high, low and close as doubles. Partial bars
    are formed before the shuffle, so a busy symbol costs one row per bar and task.
    """
    if drop_late:
        kept = flag_late(ticks, width, order=order).where("not is_late")
    else:
        kept = ticks.withColumn("bar_start", width_floor(F.col("ts"), width))
    built = kept.groupBy("symbol", "source", "bar_start").agg(
        F.min_by("price", _placed(order)).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", _placed(order)).alias("close"),
        F.sum("size").alias("size"),
        F.max(_placed(order)).alias("_last"),
    )
    last = [F.col("_last").alias(order[0])] if len(order) == 1 else [F.col(f"_last.{c}").alias(c) for c in order]
    fixed = [to_fixed(F.col(c), scale).alias(f"{c}_fixed") for c in ("open", "high", "low", "close")]
    return built.select(
        "symbol",
        "bar_start",
        (F.col("bar_start") + F.expr(f"interval {width}")).alias("bar_end"),
        *fixed,
        *(["open", "high", "low", "close"] if floats else []),
        bar_volume(F.col("size")).alias("volume"),
        "source",
        *last,
    )


def close_panel(
    bar_log: DataFrame,
    universe: Iterable[str],
    limit_periods: int | None = None,
    *,
    scale: int = SCALE,
    order: str = "seq",
) -> Panel:
    """Close prices of the newest ``limit_periods`` bar ends as a panel.

    Of repeated bars the last written one counts. Only the bars of the kept
    timestamps are placed; finding those is a distributed top-n.
    """
    names = ordered_unique(universe)
    rows = bar_log.where(F.col("symbol").isin(list(names))).select(
        "symbol",
        F.col("bar_end").alias("ts"),
        (F.col("close_fixed").cast("double") / F.lit(float(scale))).alias("price"),
        F.col(order).alias("seq"),
    )
    if limit_periods is not None:
        if limit_periods < 1:
            raise ValueError("limit_periods must be >= 1")
        newest = rows.select("ts").distinct().orderBy(F.col("ts").desc()).limit(limit_periods)
        rows = rows.join(newest, "ts", "left_semi")
    return densify(rows, names, order="seq")


def retain_per_symbol(bar_log: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` bars of each symbol.

    Spark applies the rank limit before the shuffle too, so a busy symbol sends
    at most ``keep`` rows from each task.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1")
    rank = "row_number() over (partition by symbol order by bar_end desc, seq desc)"
    return bar_log.withColumn("_rank", F.expr(rank)).where(F.col("_rank") <= keep).drop("_rank")


def retain_newest(bar_log: DataFrame, keep: int, order: str = "seq") -> DataFrame:
    """The last ``keep`` bars written, over all symbols: a bounded log."""
    if keep < 1:
        raise ValueError("keep must be >= 1")
    return bar_log.orderBy(F.col(order).desc()).limit(keep)


def recent_bars(
    bar_log: DataFrame, hours: int, now, universe: Iterable[str], *, scale: int = SCALE
) -> DataFrame:
    """Bars that ended within ``hours`` before ``now``, with their prices as doubles."""
    if hours < 1:
        raise ValueError("hours must be >= 1")
    kept = bar_log.where(
        F.col("symbol").isin(list(ordered_unique(universe)))
        & (F.col("bar_end") >= F.lit(now) - F.expr(f"interval {hours} hours"))
    )
    prices = {
        c: F.col(f"{c}_fixed").cast("double") / F.lit(float(scale))
        for c in ("open", "high", "low", "close")
    }
    return kept.withColumns(prices)


def hourly_counts(bar_log: DataFrame) -> DataFrame:
    """(hour_bucket, bars) by the hour in which a bar ended."""
    hour = F.date_trunc("hour", F.col("bar_end")).alias("hour_bucket")
    return bar_log.groupBy(hour).agg(F.count(F.lit(1)).alias("bars"))


def bar_gaps(bar_log: DataFrame, width: str = "1 minute") -> DataFrame:
    """(symbol, gap_start, gap_end, missing_bars): stretches without bars.

    Looks at consecutive bars of a symbol, day by day, with the last bar of
    earlier days carried in. A gap is one row however long it is.
    """
    starts = bar_log.select("symbol", "bar_start").distinct()
    days = starts.withColumn("_day", F.to_date("bar_start"))
    last = days.groupBy("symbol", "_day").agg(F.max("bar_start").alias("_last"))
    carried = last.selectExpr(
        "symbol",
        "_day",
        f"max(_last) over (partition by symbol order by _day {BEFORE}) as _carry",
    )
    previous = "lag(bar_start) over (partition by symbol, _day order by bar_start)"
    step = f"interval {width}"
    return (
        days.join(carried, ["symbol", "_day"])
        .withColumn("_previous", F.coalesce(F.expr(previous), "_carry"))
        .withColumn("gap_start", F.expr(f"_previous + {step}"))
        .where("gap_start < bar_start")
        .select(
            "symbol",
            "gap_start",
            F.col("bar_start").alias("gap_end"),
            F.expr(
                "(unix_micros(bar_start) - unix_micros(gap_start))"
                " div (unix_micros(gap_start) - unix_micros(_previous))"
            ).alias("missing_bars"),
        )
    )


STORE_COLUMNS = (
    ("symbol", "string"),
    ("source", "string"),
    ("bar_start", "timestamp"),
    ("bar_end", "timestamp"),
    ("open_fixed", "bigint"),
    ("high_fixed", "bigint"),
    ("low_fixed", "bigint"),
    ("close_fixed", "bigint"),
    ("open", "double"),
    ("high", "double"),
    ("low", "double"),
    ("close", "double"),
    ("volume", "double"),
)


def store_columns(store: DataFrame) -> DataFrame:
    """The known columns of a bar store, typed; absent ones are NULL.

    A store without ``bar_start`` uses ``bar_end`` for it. Text that does not
    parse becomes NULL.
    """
    present = set(store.columns)

    def typed(name: str, kind: str):
        source = "bar_end" if name == "bar_start" and name not in present else name
        if source not in present:
            return F.lit(None).cast(kind).alias(name)
        if kind == "timestamp" and store.schema[source].dataType.simpleString() == "string":
            return F.try_to_timestamp(source).alias(name)
        return F.col(source).try_cast(kind).alias(name)

    return store.select(*[typed(name, kind) for name, kind in STORE_COLUMNS])


def backfill_bars(
    store: DataFrame,
    symbols: Iterable[str],
    after,
    until,
    *,
    scale: int = SCALE,
) -> DataFrame:
    """Stored bars of the symbols that ended in (after, until], marked as backfill.

    ``after`` is a time, or a frame (symbol, after) with one time per symbol.
    Prices come from the scaled column, else from the double, else 0. A store
    partitioned by date is read for the dates in question only.
    """
    names = list(ordered_unique(symbols))
    partitioned = "date" in store.columns
    if isinstance(after, DataFrame):
        start = after.agg(F.min("after")).scalar()
    else:
        start = F.lit(after).cast("timestamp")
    end = F.lit(until).cast("timestamp")
    if partitioned:
        store = store.where(F.col("date").cast("date").between(F.to_date(start), F.to_date(end)))
    found = store_columns(store).where(
        F.col("symbol").isin(names)
        & F.col("bar_start").isNotNull()
        & (F.col("bar_end") > start)
        & (F.col("bar_end") <= end)
    )
    if isinstance(after, DataFrame):
        found = found.join(after.select("symbol", "after"), "symbol").where(
            F.col("bar_end") > F.col("after")
        )
    prices = [
        # 0 where no price is stored; a stored price that does not fit stays NULL
        F.when(F.col(f"{c}_fixed").isNull() & F.col(c).isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.coalesce(F.col(f"{c}_fixed"), to_fixed(F.col(c), scale)))
        .alias(f"{c}_fixed")
        for c in ("open", "high", "low", "close")
    ]
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("type2"))
    return found.select(
        "symbol",
        "bar_start",
        "bar_end",
        *prices,
        truncated_volume(F.col("volume"), clip=True).alias("volume"),
        F.concat(source, F.lit(":backfill")).alias("source"),
    )


def merge_backfill(live: DataFrame, backfill: DataFrame) -> DataFrame:
    """Live bars plus the stored ones they lack; one bar per symbol and end."""
    columns = [c for c in live.columns if c not in ("symbol", "bar_end")]
    both = live.withColumn("_rank", F.lit(0)).unionByName(
        backfill.withColumn("_rank", F.lit(1)), allowMissingColumns=True
    )
    return (
        both.groupBy("symbol", "bar_end")
        .agg(F.min_by(F.struct(*columns), "_rank").alias("_bar"))
        .select("symbol", "bar_end", "_bar.*")
        .select(*live.columns)
    )
