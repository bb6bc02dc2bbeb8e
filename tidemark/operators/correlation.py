"""Correlation matrices and weakly correlated pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import list_array, values_matrix
from tidemark.operators.shape import is_complete
from tidemark.panel import Panel

#: Symbols on a side of a tile of the pair matrix, and partial tiles that one task pools first.
TILE, FAN_IN = 256, 32

_NAMES = ("n", "mean_a", "mean_b", "ss_a", "ss_b", "ss_ab")
_TILES = "tile int, part int, " + ", ".join(f"{c} array<double>" for c in _NAMES)
_PAIRS = "pos_a int, pos_b int, " + ", ".join(f"{c} double" for c in _NAMES)


def _centred(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a value is known, the column means, and values about them."""
    known = np.isfinite(x)
    shift = np.where(known, x, 0.0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
    return known.astype(float), shift, np.where(known, x - shift, 0.0)


def _pair_sums(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Count, means and centred sums of the column pairs of two tiles over rows where both are known."""
    (has_a, shift_a, y_a), (has_b, shift_b, y_b) = a, b
    n = has_a.T @ has_b
    safe = np.maximum(n, 1.0)
    total_a, total_b = y_a.T @ has_b, has_a.T @ y_b
    mean_a, mean_b = total_a / safe, total_b / safe
    ss_a = (y_a * y_a).T @ has_b - total_a * mean_a
    ss_b = has_a.T @ (y_b * y_b) - total_b * mean_b
    ss_ab = y_a.T @ y_b - total_a * mean_b
    return n, mean_a + shift_a[:, None], mean_b + shift_b[None, :], ss_a, ss_b, ss_ab


def _merge(a: tuple[np.ndarray, ...] | None, b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Pooled moments of two disjoint sets of rows."""
    if a is None:
        return b
    n = a[0] + b[0]
    safe = np.maximum(n, 1.0)
    share = b[0] / safe
    step_a, step_b = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    return (
        n,
        a[1] + step_a * share,
        a[2] + step_b * share,
        a[3] + b[3] + step_a * step_a * weight,
        a[4] + b[4] + step_b * step_b * weight,
        a[5] + b[5] + step_a * step_b * weight,
    )


def _pooled(table: pa.Table) -> list[np.ndarray]:
    """The moments of one tile over all rows of the table."""
    columns = [table.column(c).combine_chunks() for c in _NAMES]
    width = len(columns[0][0])
    parts = [c.flatten().to_numpy().reshape(-1, width) for c in columns]
    pooled = None
    for i in range(table.num_rows):
        pooled = _merge(pooled, tuple(p[i] for p in parts))
    return list(pooled)


def pair_moments(rows: DataFrame, width: int) -> DataFrame:
    """Per symbol pair: n, means and centred sums over the rows where both are known.

    A task reduces its rows to one matrix per tile of ``TILE`` x ``TILE`` pairs, each a row of
    arrays. Tiles are pooled in two levels, FAN_IN groups of tasks first, and unpacked to pairs at
    the end, so that rows shuffled grow with tasks x tiles and no task holds the whole matrix.
    """
    cuts = list(range(0, width, TILE))
    tiles = [(a, b) for a in range(len(cuts)) for b in range(a, len(cuts))]

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [None] * len(tiles)
        for batch in batches:
            if batch.num_rows:
                x = values_matrix(batch.column(0), width)
                sides = [_centred(x[:, at : at + TILE]) for at in cuts]
                for i, (a, b) in enumerate(tiles):
                    held[i] = _merge(held[i], _pair_sums(sides[a], sides[b]))
        part = TaskContext.get().partitionId() % FAN_IN
        for i, moments in enumerate(held):
            if moments is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([part], pa.int32()), *[list_array(m.reshape(1, -1)) for m in moments]],
                    names=["tile", "part", *_NAMES],
                )

    def pool(table: pa.Table) -> pa.Table:
        moments = _pooled(table)
        return pa.table(
            {
                "tile": table.column("tile").slice(0, 1),
                "part": pa.array([0], pa.int32()),
                **{c: list_array(m.reshape(1, -1)) for c, m in zip(_NAMES, moments)},
            }
        )

    def unpack(table: pa.Table) -> pa.Table:
        a, b = tiles[table.column("tile")[0].as_py()]
        high, wide = min(TILE, width - cuts[a]), min(TILE, width - cuts[b])
        at = np.triu_indices(high, 1, wide) if a == b else np.indices((high, wide)).reshape(2, -1)
        picked = [m.reshape(high, wide)[at[0], at[1]] for m in _pooled(table)]
        columns = {"pos_a": (at[0] + cuts[a]).astype(np.int32), "pos_b": (at[1] + cuts[b]).astype(np.int32)}
        return pa.table({**columns, **dict(zip(_NAMES, picked))})

    parts = rows.select("values").mapInArrow(reduce_task, _TILES)
    grouped = parts.groupBy("tile", "part").applyInArrow(pool, _TILES)
    return grouped.groupBy("tile").applyInArrow(unpack, _PAIRS)


def correlation(panel: Panel, *, deletion: str = "listwise", full: bool = False) -> DataFrame:
    """(symbol_a, symbol_b, pos_a, pos_b, correlation): Pearson r of every symbol pair.

    ``listwise`` uses the rows where all symbols are known, ``pairwise`` those
    where both of the pair are. A constant series has no correlation (NULL).
    Pairs come once, in universe order; ``full`` gives the square matrix.
    """
    if panel.width < 2:
        raise ValueError("need at least 2 symbols to compute correlations")
    if deletion not in ("listwise", "pairwise"):
        raise ValueError("deletion must be 'listwise' or 'pairwise'")
    rows = panel.rows.where(is_complete()) if deletion == "listwise" else panel.rows
    moments = pair_moments(rows, panel.width)
    norm = F.sqrt(F.col("ss_a")) * F.sqrt(F.col("ss_b"))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide("ss_ab", norm)))
    r = F.when((F.col("ss_a") > 0) & (F.col("ss_b") > 0), bounded)
    pairs = moments.select("pos_a", "pos_b", r.alias("correlation"))
    if full:
        cell = F.array(
            F.struct("pos_a", "pos_b", "correlation"),
            F.struct(
                F.col("pos_b").alias("pos_a"), F.col("pos_a").alias("pos_b"), "correlation"
            ),
        )
        diagonal = _own_correlation(panel, rows)
        pairs = pairs.select(F.inline(cell)).unionByName(diagonal)
    return pairs.select(
        panel.symbol_at("pos_a").alias("symbol_a"),
        panel.symbol_at("pos_b").alias("symbol_b"),
        "pos_a",
        "pos_b",
        "correlation",
    )


def _own_correlation(panel: Panel, rows: DataFrame) -> DataFrame:
    cells = rows.select(F.expr("posexplode(values) as (pos, x)"))
    return cells.groupBy("pos").agg(F.stddev_pop("x").alias("_sd")).select(
        F.col("pos").alias("pos_a"),
        F.col("pos").alias("pos_b"),
        F.when(F.col("_sd") > 0, F.lit(1.0)).alias("correlation"),
    )


def correlation_outliers(pairs: DataFrame, *, low_threshold: float = 0.3) -> DataFrame:
    """(symbol_a, symbol_b, correlation) of the pairs below the threshold, lowest first.

    The unrounded value is compared, the value rounded to 4 places is reported
    and ordered; equal ones stay in universe order.
    """
    low = pairs.where((F.col("correlation") < low_threshold) & (F.col("pos_a") < F.col("pos_b")))
    return (
        low.withColumn("correlation", F.round("correlation", 4))
        .orderBy("correlation", "pos_a", "pos_b")
        .select("symbol_a", "symbol_b", "correlation")
    )
