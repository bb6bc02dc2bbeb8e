"""Missing shares, replacement of sparse symbols, and gap filling."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import list_array, values_matrix
from tidemark.operators.ordinals import BEFORE, block_length, own_block
from tidemark.panel import Panel, ordered_unique, universe_frame


def missing_fraction(panel: Panel) -> DataFrame:
    """(symbol, pos, missing_frac): share of rows without a value, one row per symbol."""
    return (
        panel.cells()
        .groupBy("pos")
        .agg(F.avg(F.col("value").isNull().cast("int")).alias("missing_frac"))
        .select(panel.symbol_at().alias("symbol"), "pos", "missing_frac")
    )


def zombie_replacements(
    fractions: DataFrame,
    primaries: Iterable[str],
    reserves: Iterable[str],
    *,
    threshold: float = 0.05,
    require_healthy: bool = False,
) -> DataFrame:
    """(pos, dropped, replaced_with, missing_frac): a rank join of two short lists.

    A primary whose missing share is above the threshold is dropped. The i-th
    dropped primary gets the i-th reserve that is not itself a primary;
    ``replaced_with`` is NULL where the reserves ran out. Both sides are at most
    as long as the universe lists, so ranking them needs no partitioning.
    """
    spark = fractions.sparkSession
    first = universe_frame(spark, primaries)
    bench = universe_frame(spark, reserves).join(first, "symbol", "left_anti")
    shares = fractions.select("symbol", "missing_frac")
    if require_healthy:
        healthy = shares.where(F.col("missing_frac") <= threshold)
        bench = bench.join(healthy.select("symbol"), "symbol", "left_semi")
    by_pos = Window.orderBy("pos")
    dropped = (
        first.join(shares, "symbol")
        .where(F.col("missing_frac") > threshold)
        .select(
            "pos",
            F.col("symbol").alias("dropped"),
            "missing_frac",
            F.row_number().over(by_pos).alias("_rank"),
        )
    )
    ranked = bench.select(
        F.col("symbol").alias("replaced_with"), F.row_number().over(by_pos).alias("_rank")
    )
    return dropped.join(ranked, "_rank", "left").select(
        "pos", "dropped", "replaced_with", "missing_frac"
    )


def replace_zombies(
    panel: Panel,
    primaries: Iterable[str],
    reserves: Iterable[str],
    *,
    threshold: float = 0.05,
    require_healthy: bool = False,
) -> tuple[Panel, DataFrame]:
    """The panel of the healthy universe, and the replacements made.

    Reads the replacement table once (at most one row per primary) to pick the
    array slots; everything else stays lazy. Raises when the reserves run out.
    """
    chosen = list(ordered_unique(primaries))
    replacements = zombie_replacements(
        missing_fraction(panel),
        chosen,
        reserves,
        threshold=threshold,
        require_healthy=require_healthy,
    )
    made = sorted(replacements.collect(), key=lambda row: row.pos)
    for row in made:
        if row.replaced_with is None:
            raise ValueError(f"no reserve left to replace {row.dropped}")
        chosen[row.pos] = row.replaced_with
    known = panel.spark.createDataFrame(made, replacements.schema)
    return panel.select_symbols(chosen), known


def fill_gaps(panel: Panel, *, limit: int = 2, direction: str = "both") -> Panel:
    """Linear fill over open rows, at most ``limit`` cells from a known value.

    The step along the line is one open row; closed rows stay empty. With
    ``direction='both'`` a cell is filled when a known value lies within the
    limit on either side, with ``'forward'`` only after one. Cells beyond the
    last (or, for both, before the first) known value repeat it.

    The nearest known value may lie any number of rows away. Each block
    therefore reports its number of open rows and, per symbol, its first and last
    known value; these short tables are scanned over the blocks, and each block is
    filled as a matrix with what is carried in.
    """
    if limit < 1:
        raise ValueError("limit must be >= 1")
    if direction not in ("both", "forward"):
        raise ValueError("direction must be 'both' or 'forward'")
    width = panel.width
    blocked = panel.rows.withColumn("block", own_block(block_length(width, limit)))

    def summary(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        x = values_matrix(table.column("values"), width)
        place, known = _open_places(x), np.isfinite(x)
        some = known.any(axis=0)
        first, last = known.argmax(axis=0), len(x) - 1 - known[::-1].argmax(axis=0)
        at = np.arange(width)

        def cells(values: np.ndarray) -> pa.Array:
            return list_array(np.where(some, values, np.nan).astype(float).reshape(1, -1))

        return pa.table(
            {
                "block": table.column("block").slice(0, 1),
                "opened": pa.array([int(known.any(axis=1).sum())], pa.int64()),
                "first_o": cells(place[first]),
                "first_x": cells(x[first, at]),
                "last_o": cells(place[last]),
                "last_x": cells(x[last, at]),
            }
        )

    lists = "first_o array<double>, first_x array<double>, last_o array<double>, last_x array<double>"
    edges = blocked.groupBy("block").applyInArrow(summary, f"block bigint, opened bigint, {lists}")
    # places are counted over all blocks; one row per block and symbol from here on
    counted = edges.withColumn("_before", F.expr(f"coalesce(sum(opened) over (order by block {BEFORE}), 0L)"))
    spread = counted.selectExpr(
        "block", "_before", "posexplode(arrays_zip(first_o, first_x, last_o, last_x)) as (pos, e)"
    ).selectExpr(
        "block",
        "_before",
        "pos",
        "if(e.first_x is null, null, struct(e.first_o + _before as o, e.first_x as x)) as first_known",
        "if(e.last_x is null, null, struct(e.last_o + _before as o, e.last_x as x)) as last_known",
    )
    # Reading forward in descending order keeps the frame growing from its
    # start, which Spark updates in place.
    prev = (
        f"last_value(last_known) ignore nulls over (partition by pos order by block {BEFORE})"
    )
    following = (
        f"last_value(first_known) ignore nulls over (partition by pos order by block desc {BEFORE})"
    )
    carried = (
        spread.selectExpr("block", "_before", "pos", f"{prev} as prev", f"{following} as next")
        .groupBy("block", "_before")
        .agg(F.expr("array_sort(collect_list(struct(pos, prev, next))) as c"))
        .selectExpr("block", "_before", "c.prev.o as prev_o", "c.prev.x as prev_x", "c.next.o as next_o", "c.next.x as next_x")
    )

    def fill(rows: pa.Table, carry: pa.Table) -> pa.Table:
        rows = rows.sort_by("ord")
        x = values_matrix(rows.column("values"), width)
        place = _open_places(x) + carry.column("_before")[0].as_py()
        sides = [values_matrix(carry.column(c), width)[0] for c in ("prev_o", "prev_x", "next_o", "next_x")]
        filled = _filled(x, place, *sides, limit, direction == "both")
        return pa.table({"ts": rows.column("ts"), "ord": rows.column("ord"), "values": list_array(filled)})

    kind = panel.rows.schema["ts"].dataType.simpleString()
    both = blocked.groupBy("block").cogroup(carried.groupBy("block"))
    return panel.with_rows(both.applyInArrow(fill, f"ts {kind}, ord bigint, values array<double>"))


def _open_places(x: np.ndarray) -> np.ndarray:
    """The number of each row among the open rows, as a closed row has that of the open one before it."""
    return np.cumsum(np.isfinite(x).any(axis=1)).astype(float)


def _filled(x, place, prev_o, prev_x, next_o, next_x, limit: int, both: bool) -> np.ndarray:
    """The block with gaps filled; the sides are the nearest known values outside, NaN where there is none."""
    rows, width = x.shape
    known, at = np.isfinite(x), np.arange(width)
    number = np.arange(rows)[:, None]
    last = np.maximum.accumulate(np.where(known, number, -1), axis=0)
    coming = np.minimum.accumulate(np.where(known, number, rows)[::-1], axis=0)[::-1]
    o = place[:, None]
    before_o = np.where(last >= 0, place[last.clip(0)], prev_o)
    before_x = np.where(last >= 0, x[last.clip(0), at], prev_x)
    after_o = np.where(coming < rows, place[coming.clip(None, rows - 1)], next_o)
    after_x = np.where(coming < rows, x[coming.clip(None, rows - 1), at], next_x)
    has_before, has_after = np.isfinite(before_x), np.isfinite(after_x)
    near = has_before & (o - before_o <= limit)
    if both:
        near |= has_after & (after_o - o <= limit)
    with np.errstate(invalid="ignore", divide="ignore"):
        line = before_x + (after_x - before_x) * (o - before_o) / (after_o - before_o)
    line = np.where(has_before, np.where(has_after, line, before_x), after_x)
    reached = near & known.any(axis=1)[:, None]
    return np.where(known, x, np.where(reached, line, np.nan))
