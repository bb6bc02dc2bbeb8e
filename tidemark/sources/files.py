"""Price, bar and run-history tables on files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.folders import folder_names, numbered_folders
from tidemark.functions import clean_text, parse_iso_optional
from tidemark.panel import ordered_unique
from tidemark.schemas import with_utc


def read_price_panel(
    spark: SparkSession,
    path: str,
    tickers: Iterable[str],
    start,
    end,
    *,
    price_col: str = "adj_close",
    symbol_col: str = "symbol",
    ts_col: str = "ts",
    fmt: str = "parquet",
    schema: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """(symbol, ts, price) of the tickers in [start, end).

    The time and symbol filters reach the file scan and only three columns are
    read. A file without the price column is an error; so is an empty result
    with ``strict``. ``fmt`` may be parquet, csv or json.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema:
        reader = reader.schema(schema)
    table = reader.load(path)
    if price_col not in table.columns:
        raise ValueError(f"{path} has no column {price_col}")
    names = list(ordered_unique(tickers))
    ts = F.col(ts_col)
    kept = (
        table.where(F.col(symbol_col).isin(names))
        .where((ts >= F.lit(start)) & (ts < F.lit(end)))
        .select(
            F.col(symbol_col).alias("symbol"),
            ts.alias("ts"),
            F.col(price_col).cast("double").alias("price"),
        )
    )
    kept = with_utc(kept)
    if strict and not kept.take(1):
        raise ValueError("no prices in the requested range")
    return kept


def parse_bar_log(messages: DataFrame, universe: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Text bars (symbol, bar_start, bar_end, open, .., volume, source, seq) to typed ones.

    Returns the good bars and the rejected rows: those of a universe symbol with
    a missing or unreadable time or number. Rows of other symbols are dropped.
    """
    names = list(ordered_unique(universe))
    mine = messages.withColumn("symbol", clean_text(F.col("symbol"))).where(
        F.col("symbol").isin(names)
    )
    fixed = {f"{c}_fixed": F.col(c).try_cast("bigint") for c in ("open", "high", "low", "close")}
    parsed = {
        "_start": parse_iso_optional(F.col("bar_start")),
        "_end": parse_iso_optional(F.col("bar_end")),
        "_volume": F.col("volume").try_cast("double").try_cast("bigint"),
        **fixed,
    }
    typed = mine.withColumns(parsed)
    readable = F.lit(True)
    for name in parsed:
        readable = readable & F.col(name).isNotNull()
    good = typed.where(readable).select(
        "symbol",
        F.col("_start").alias("bar_start"),
        F.col("_end").alias("bar_end"),
        *fixed,
        F.col("_volume").alias("volume"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        "seq",
    )
    return good, typed.where(~readable).select(*messages.columns)


def store_hours(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> list[tuple[str, int]]:
    """The (date, hour) of each folder of the store, ascending, from folder names alone.

    ``dates`` limits the listing to these days.
    """
    days = [d.removeprefix("date=") for d in folder_names(spark, path) if d.startswith("date=")]
    if dates is not None:
        days = sorted(set(days) & set(dates))
    return sorted((day, hour) for day in days for hour in numbered_folders(spark, f"{path}/date={day}", "hour"))


def read_store_hours(
    spark: SparkSession, path: str, hours: Iterable[tuple[str, int]], *, skip_unreadable: bool = False
) -> DataFrame | None:
    """The bars of these hours; only their folders are opened. None without hours."""
    folders = [f"{path}/date={day}/hour={hour}" for day, hour in hours]
    if not folders:
        return None
    reader = spark.read.option("mergeSchema", True).option("basePath", path)
    return reader.option("ignoreCorruptFiles", skip_unreadable).parquet(*folders)


def read_bar_store(
    spark: SparkSession, path: str, *, start=None, end=None, skip_unreadable: bool = False
) -> DataFrame:
    """The (date, hour) partitioned bar store; files may lack columns.

    ``start`` and ``end`` are bar ends; folders outside are not opened, not even for the
    schema, and rows are filtered. A file that cannot be read is an error unless
    ``skip_unreadable``.
    """
    if start is None and end is None:
        reader = spark.read.option("mergeSchema", True)
        return reader.option("ignoreCorruptFiles", skip_unreadable).parquet(path)
    bounds = spark.range(1).select(*[
        F.date_format(F.lit(at).cast("timestamp"), "yyyy-MM-dd HH") for at in (start, end)
    ]).first()
    low, high = ((b[:10], int(b[11:])) if b else None for b in bounds)
    hours = store_hours(spark, path)
    wanted = [h for h in hours if (low is None or h >= low) and (high is None or h <= high)]
    # no folder in range: the newest one gives the columns
    store = read_store_hours(spark, path, wanted or hours[-1:], skip_unreadable=skip_unreadable)
    if store is None:
        return read_bar_store(spark, path, skip_unreadable=skip_unreadable)
    at = F.col("bar_end").cast("timestamp")
    if start is not None:
        store = store.where(at >= F.lit(start).cast("timestamp"))
    if end is not None:
        store = store.where(at <= F.lit(end).cast("timestamp"))
    return store


def read_newest_hour(spark: SparkSession, path: str, *, skip_unreadable: bool = False) -> DataFrame | None:
    """The bars of the newest folder of the store; None if there is none."""
    days = [d for d in folder_names(spark, path) if d.startswith("date=")]
    for day in sorted(days, reverse=True):
        hours = store_hours(spark, path, [day.removeprefix("date=")])
        if hours:
            return read_store_hours(spark, path, hours[-1:], skip_unreadable=skip_unreadable)
    return None


def read_run_history(spark: SparkSession, path: str) -> DataFrame:
    """Metadata of all runs, newest first."""
    return spark.read.option("mergeSchema", True).parquet(path).orderBy(F.col("run_ts").desc())
