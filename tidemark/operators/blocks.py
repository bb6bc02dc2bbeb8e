"""Panel rows by time block as NumPy matrices.

Spark places the rows by block, with the frame's reach repeated in front; Python
sees one bounded block at a time and returns rows of the same shape.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.operators.ordinals import block_length, with_halo
from tidemark.panel import Panel


def values_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List values as a matrix, NaN where a value is missing."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, width)


def list_array(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow list column; a NaN becomes a missing value."""
    rows, width = matrix.shape
    flat = pa.array(matrix.reshape(-1), from_pandas=True)
    if matrix.size < 1 << 31:
        return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), flat)
    return pa.LargeListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int64) * width), flat)


def by_block(
    panel: Panel, reach: int, compute: Callable[[np.ndarray, int], list[np.ndarray]], names: list[str]
) -> DataFrame:
    """Run ``compute(x, first_own_row)`` on each block; it returns one matrix per name."""
    width = panel.width

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ord")
        x = values_matrix(table.column("values"), width)
        own = table.column("own").to_numpy() == table.column("block").to_numpy()
        # the repeated rows come first in time; a block may consist of them alone
        start = int(len(own) - own.sum())
        kept = table.slice(start)
        columns = {"ts": kept.column("ts"), "ord": kept.column("ord")}
        for name, matrix in zip(names, compute(x, start)):
            columns[name] = list_array(matrix[start:])
        return pa.table(columns)

    lists = ", ".join(f"{name} array<double>" for name in names)
    kind = panel.rows.schema["ts"].dataType.simpleString()
    spread = with_halo(panel.rows, block_length(panel.width, reach), reach)
    rows = spread.select("block", "own", "ts", "ord", "values")
    return rows.groupBy("block").applyInArrow(run, f"ts {kind}, ord bigint, {lists}")


def running_moments(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sum of squared deviations of the last ``window`` rows, NaN before and where one is missing.

    The rows are cut into pieces as long as the window. Moments from the start of each piece and
    to its end are updated row by row, for all pieces and columns at once, and a frame is the end
    of one piece joined to the start of the next. Nothing is subtracted again, so an outlier that has left
    the frame leaves no error behind, and a constant frame has exactly no deviation.
    """
    rows, width = x.shape
    pieces = -(-rows // window)
    there = np.isfinite(x)
    y = np.zeros((pieces * window, width))
    y[:rows] = np.where(there, x, 0.0)
    y = y.reshape(pieces, window, width)
    mean, square = np.empty_like(y), np.empty_like(y)
    tail_mean, tail_square = np.empty_like(y), np.empty_like(y)
    for m, s, at in ((mean, square, range(window)), (tail_mean, tail_square, range(window - 1, -1, -1))):
        now, total = np.zeros((pieces, width)), np.zeros((pieces, width))
        for n, j in enumerate(at, 1):
            step = y[:, j] - now
            now = now + step / n
            total = total + step * (y[:, j] - now)
            m[:, j], s[:, j] = now, total
    # a frame that ends at place j has window - 1 - j rows in the piece before
    ahead = np.arange(1, window + 1, dtype=float)[None, :, None]
    behind = window - ahead
    before_mean, before_square = np.zeros_like(y), np.zeros_like(y)
    before_mean[1:, :-1], before_square[1:, :-1] = tail_mean[:-1, 1:], tail_square[:-1, 1:]
    step = mean - before_mean
    means = before_mean + step * (ahead / window)
    squares = before_square + square + step * step * (ahead * behind / window)
    # a whole piece is a frame of its own
    means[:, -1], squares[:, -1] = mean[:, -1], square[:, -1]
    counts = np.cumsum(there, axis=0)
    counts[window:] -= counts[:-window].copy()
    whole = counts == window
    whole[: window - 1] = False
    means, squares = (m.reshape(-1, width)[:rows] for m in (means, squares))
    return np.where(whole, means, np.nan), np.where(whole, squares, np.nan)
