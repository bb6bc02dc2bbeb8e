"""Row numbers and time blocks without a task that sees the whole series.

Rolling operators need the ordinal of a row in its series. An unpartitioned
``row_number`` would send the series through one task, and so would a window
per symbol once a symbol holds most of the data. Here a series is cut into
cells of bounded size, the cells are counted, the counts are summed up to
offsets, and rows are numbered inside their cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import work_dir

TARGET_CELLS = 1 << 18

#: Rows that one task puts in order, and the most tasks that rows are cut for.
CELL_ROWS = 1 << 20
MOST_CELLS = 100_000

BEFORE = "rows between unbounded preceding and 1 preceding"


def store_in_order(rows: DataFrame, path: str, order: str) -> DataFrame:
    """Write rows sorted by a unique column and read them back with ``ord``, from 0.

    Range partitioning spreads the sort; ``monotonically_increasing_id`` names a
    row by write task and place in it, and the file keeps that name for good. The
    tasks' row counts, one per write task, are all that has to be summed up.
    """
    (
        rows.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    schema = rows.withColumn("_at", F.lit(0).cast("bigint")).schema
    kept = rows.sparkSession.read.schema(schema).parquet(path).withColumn(
        "_task", F.expr("shiftright(_at, 33)")
    )
    offsets = (
        kept.groupBy("_task")
        .agg(F.expr("count(1) as _n"))
        .selectExpr("_task", f"coalesce(sum(_n) over (order by _task {BEFORE}), 0L) as _offset")
    )
    # one row per write task, so it is always small enough to broadcast
    return kept.join(F.broadcast(offsets), "_task").selectExpr(
        *rows.columns, "_offset + (_at & 8589934591L) as ord"
    )


def in_cells(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cell_rows: int = CELL_ROWS
) -> DataFrame | None:
    """The rows with ``_cell`` and ``_at``, cut along (keys, order) into runs of about ``cell_rows``.

    None if all rows fit one cell. The cuts come from the data: rows are range partitioned and
    written sorted, and a cell is what one task wrote, so it is bounded whatever the numbers in
    ``order`` look like and however many rows one key holds. ``_at`` numbers the rows of a cell.
    """
    rows = df.count()
    if rows <= cell_rows:
        return None
    path = work_dir(df.sparkSession, "cells")
    (
        df.repartitionByRange(min(-(-rows // cell_rows), MOST_CELLS), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    schema = df.withColumn("_at", F.lit(0).cast("bigint")).schema
    kept = df.sparkSession.read.schema(schema).parquet(path)
    return kept.withColumns({"_cell": F.expr("shiftright(_at, 33)"), "_at": F.expr("_at & 8589934591L")})


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Add ``name``: the largest ``value`` of the rows of a key before a row; NULL for its first.

    With many rows, cells report their maximum, these are scanned per key, and rows look back
    inside their cell only, so no task holds a key.
    """
    names = ", ".join(keys)
    cells = in_cells(df, keys, order, cell_rows)
    if cells is None:
        return df.withColumn(name, F.expr(f"max({value}) over (partition by {names} order by {', '.join(order)} {BEFORE})"))
    peaks = cells.groupBy(*keys, "_cell").agg(F.max(value).alias("_peak"))
    carried = peaks.selectExpr(
        *keys, "_cell", f"max(_peak) over (partition by {names} order by _cell {BEFORE}) as _carry"
    )
    inside = f"max({value}) over (partition by {names}, _cell order by _at {BEFORE})"
    both = cells.join(carried, [*keys, "_cell"])
    return both.withColumn(name, F.greatest(F.expr(inside), "_carry")).drop("_cell", "_at", "_carry")


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Add ``ord``: the rank of a row from 0 inside its key.

    ``order`` is one column or several that are unique within the key. A row's rank is its
    place in its cell plus the rows of its key in earlier cells.
    """
    order = [order] if isinstance(order, str) else list(order)
    names = ", ".join(keys)
    cells = in_cells(df, keys, order, cell_rows)
    if cells is None:
        rank = f"row_number() over (partition by {names} order by {', '.join(order)})"
        return df.withColumn("ord", F.expr(f"cast({rank} - 1 as bigint)"))
    counts = cells.groupBy(*keys, "_cell").agg(F.expr("count(1) as _n"), F.min("_at").alias("_first"))
    offsets = counts.selectExpr(
        *keys,
        "_cell",
        "_first",
        f"coalesce(sum(_n) over (partition by {names} order by _cell {BEFORE}), 0L) as _offset",
    )
    return (
        cells.join(offsets, [*keys, "_cell"])
        .withColumn("ord", F.expr("_offset + _at - _first"))
        .drop("_cell", "_at", "_first", "_offset")
    )


def renumber(rows: DataFrame, block: str) -> DataFrame:
    """Recompute ``ord`` after rows were dropped, keeping the order.

    ``block`` grows with ``ord``. The table of block counts is smaller than the
    rows by the block size, and rows already placed by block are not moved.
    """
    counts = rows.groupBy(block).agg(F.expr("count(1) as _n"))
    offsets = counts.selectExpr(
        block, f"coalesce(sum(_n) over (order by {block} {BEFORE}), 0L) as _offset"
    )
    rank = f"row_number() over (partition by {block} order by ord)"
    return (
        rows.withColumn("_rank", F.expr(rank))
        .join(offsets, block)
        .withColumn("ord", F.expr("_offset + _rank - 1"))
        .drop("_rank", "_offset")
    )


def block_length(width: int, reach: int) -> int:
    """Rows per time block: about TARGET_CELLS values, and well over the reach."""
    return max(4 * max(reach, 1), TARGET_CELLS // max(width, 1), 1)


def own_block(length: int) -> Column:
    return F.expr(f"ord div {length}")


def with_halo(rows: DataFrame, length: int, reach: int) -> DataFrame:
    """Place rows by ``block``, repeating the ``reach`` rows before each block.

    A frame of ``reach`` preceding rows then never leaves its block. Rows with
    ``block <> own`` are the repeated ones; callers drop them after the frame.
    """
    if reach > length:
        raise ValueError("a block must be at least as long as the reach")
    own = f"ord div {length}"
    targets = f"if(ord % {length} >= {length - reach}, array({own}, {own} + 1), array({own}))"
    return rows.selectExpr("*", f"{own} as own", f"explode({targets}) as block")
