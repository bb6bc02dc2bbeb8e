"""The panel: one row per timestamp, one array slot per symbol.

A panel row holds the values of all symbols in universe order, so a row is
complete or not without a join, a shuffle moves eight bytes per value, and
every cross-sectional operator works row by row. The tidy form
``(symbol, ts, value)`` is read and written at the edges.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import finite_or_null
from tidemark.operators.ordinals import store_in_order
from tidemark.schemas import require_time
from tidemark.session import work_dir


def ordered_unique(symbols: Iterable[str]) -> tuple[str, ...]:
    """Drop repeated symbols, keeping the first of each."""
    return tuple(dict.fromkeys(symbols))


def universe_frame(spark: SparkSession, symbols: Iterable[str]) -> DataFrame:
    """(symbol, pos). A local table: Spark knows its size when it plans a join."""
    names = ordered_unique(symbols)
    table = pa.table(
        {
            "symbol": pa.array(names, pa.string()),
            "pos": pa.array(range(len(names)), pa.int32()),
        }
    )
    return spark.createDataFrame(table)


def text_array(values: Iterable[str]) -> str:
    """SQL text of a constant string array."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return "array(" + ", ".join(f"'{v}'" for v in quoted) + ")"


@dataclass(frozen=True)
class Panel:
    """rows: (ts, ord, values array<double>), ord counting rows from 0 by time."""

    rows: DataFrame
    symbols: tuple[str, ...]

    @property
    def width(self) -> int:
        return len(self.symbols)

    @property
    def spark(self) -> SparkSession:
        return self.rows.sparkSession

    def with_rows(self, rows: DataFrame) -> Panel:
        return replace(self, rows=rows.select("ts", "ord", "values"))

    def stored(self, label: str = "panel") -> Panel:
        """The same panel, written once to the shared working folder and read back.

        Operators read their input more than once, so a chain of them should not
        hang on one long lineage. The written rows also outlive lost executors.
        """
        path = work_dir(self.spark, label)
        self.rows.write.parquet(path)
        return self.with_rows(self.spark.read.schema(self.rows.schema).parquet(path))

    def symbol_at(self, pos: str = "pos") -> Column:
        """The symbol in the slot that column ``pos`` names."""
        return F.expr(f"{text_array(self.symbols)}[{pos}]")

    def cells(self, value: str = "value") -> DataFrame:
        """(ts, ord, pos, value), every slot of every row."""
        return self.rows.selectExpr("ts", "ord", f"posexplode(values) as (pos, {value})")

    def long(self, value: str = "value") -> DataFrame:
        """(symbol, ts, value), every symbol at every timestamp."""
        return self.cells(value).select(self.symbol_at().alias("symbol"), "ts", value)

    def wide(self) -> DataFrame:
        """(ts, one column per symbol)."""
        return self.rows.select(
            "ts", *[F.col("values")[i].alias(s) for i, s in enumerate(self.symbols)]
        )

    def select_symbols(self, symbols: Iterable[str]) -> Panel:
        """The panel of the given symbols, in the given order; unknown ones are NULL."""
        names = tuple(symbols)
        slot = {s: i for i, s in enumerate(self.symbols)}
        picked = [
            f"values[{slot[s]}]" if s in slot else "cast(null as double)" for s in names
        ]
        rows = self.rows.selectExpr("ts", "ord", f"array({', '.join(picked)}) as values")
        return Panel(rows, names)

    def last_rows(self, n: int) -> DataFrame:
        """The newest n rows; n is a window length.

        The oldest of their timestamps is found from the timestamps alone, now, so
        that the read of the values is filtered by time: stored rows are in time
        order, and files and row groups before it are skipped.
        """
        newest = self.rows.select("ts").orderBy(F.col("ts").desc()).limit(n)
        oldest = newest.agg(F.min("ts")).first()[0]
        if oldest is None:
            return self.rows.limit(0)
        return self.rows.where(F.col("ts") >= F.lit(oldest)).orderBy(F.col("ts").desc()).limit(n)


def densify(
    df: DataFrame,
    symbols: Iterable[str],
    *,
    symbol: str = "symbol",
    ts: str = "ts",
    value: str = "price",
    order: str | None = None,
) -> Panel:
    """Tidy rows to a panel: every universe symbol at every timestamp, NULL if absent.

    Repeated (symbol, ts) rows are reduced before they are placed: to the one
    with the highest ``order``, or to the largest value when there is no order.
    The timestamps are those of any universe symbol, including rows whose value
    is missing. NaN and infinities count as missing.

    The input is read once, now: the rows are written in time order to the
    shared working folder, which is also what gives them their numbers.
    """
    require_time(df, ts)
    names = ordered_unique(symbols)
    if not names:
        raise ValueError("a panel needs at least one symbol")
    universe = universe_frame(df.sparkSession, names)
    columns = [F.col(symbol).alias("symbol"), F.col(ts).alias("ts")]
    if order:
        columns.append(F.col(order).alias("_order"))
    placed = df.select(*columns, finite_or_null(F.col(value)).alias("_value")).join(
        universe, "symbol"
    )
    if order:
        newest = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_order")))
    else:
        newest = F.max("_value")
    cells = placed.groupBy("ts", "pos").agg(newest.alias("_value"))
    wide = cells.groupBy("ts").pivot("pos", list(range(len(names)))).agg(F.max("_value"))
    slots = ", ".join(f"`{i}`" for i in range(len(names)))
    rows = wide.selectExpr("ts", f"array({slots}) as values")
    numbered = store_in_order(rows, work_dir(df.sparkSession, "rows"), "ts")
    return Panel(numbered.select("ts", "ord", "values"), names)
