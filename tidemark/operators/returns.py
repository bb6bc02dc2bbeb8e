"""Log returns, rolling z-scores and scaler parameters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import by_block, running_moments
from tidemark.operators.ordinals import block_length, renumber, with_halo
from tidemark.operators.shape import is_complete
from tidemark.panel import Panel


def _require_rows(panel: Panel, least: int, what: str) -> None:
    if len(panel.rows.select("ts").limit(least).collect()) < least:
        raise ValueError(f"need at least {least} rows for {what}")


def log_returns(panel: Panel, *, complete_case: bool = True, strict: bool = False) -> Panel:
    """ln of each price over the one in the previous row of the panel.

    Undefined ratios (missing, zero, opposite sign) are missing returns. With
    ``complete_case`` a row stays only if every symbol has a return, so the
    first row always goes. One move of the rows, by time block.
    """
    if strict:
        _require_rows(panel, 2, "log returns")
    spread = with_halo(panel.rows, block_length(panel.width, 1), 1).repartition("block")
    by_time = Window.partitionBy("block").orderBy("ord")
    ratios = F.expr("zip_with(values, _previous, (p, q) -> ln(try_divide(p, q)))")
    rows = (
        spread.withColumn("_previous", F.lag("values").over(by_time))
        .where("block = own")
        .select("block", "ts", "ord", ratios.alias("values"))
    )
    if complete_case:
        return panel.with_rows(renumber(rows.where(is_complete()), "block"))
    empty = F.array_repeat(F.lit(None).cast("double"), panel.width)
    return panel.with_rows(rows.withColumn("values", F.coalesce("values", empty)))


def _guarded(sd: str, eps: float) -> str:
    return f"if({sd} = 0, {float(eps)!r}D, {sd})"


def rolling_zscore_cells(
    panel: Panel, *, window: int = 60, eps: float = 1e-9, drop_partial: bool = False
) -> DataFrame:
    """(ts, ord, pos, value): z-score of each cell against its last ``window`` rows."""
    rows = _zscore_rows(panel, window, eps, drop_partial)
    return rows.selectExpr("ts", "ord", "posexplode(values) as (pos, value)")


def _zscore_rows(panel: Panel, window: int, eps: float, drop_partial: bool) -> DataFrame:
    """(ts, ord, values): z-scores, row by row.

    Mean and population deviation include the row itself. A frame that is not
    full, or that misses a value, gives NULL; ``drop_partial`` leaves out the
    rows before the first full frame. A cell costs the same whatever the window.
    """
    if window < 2:
        raise ValueError("window must be >= 2")

    def compute(x: np.ndarray, start: int) -> list[np.ndarray]:
        mean, squares = running_moments(x, window)
        sd = np.sqrt(squares / window)
        return [(x - mean) / np.where(sd == 0.0, eps, sd)]

    rows = by_block(panel, window - 1, compute, ["values"])
    return rows.where(f"ord >= {window - 1}") if drop_partial else rows


def rolling_zscore(
    panel: Panel,
    *,
    window: int = 60,
    eps: float = 1e-9,
    drop_partial: bool = False,
    strict: bool = False,
) -> Panel:
    """The z-score panel. With ``drop_partial`` rows are numbered from the first full frame."""
    if strict:
        _require_rows(panel, window, "a rolling z-score")
    rows = _zscore_rows(panel, window, eps, drop_partial)
    if drop_partial:
        rows = rows.withColumn("ord", F.col("ord") - F.lit(window - 1))
    return panel.with_rows(rows)


def latest_by_symbol(panel: Panel, value: str = "value") -> DataFrame:
    """(symbol, ts, value) of the newest row."""
    newest = Panel(panel.last_rows(1), panel.symbols)
    return newest.long(value)


def latest_zscore(
    panel: Panel, *, window: int = 60, eps: float = 1e-12, strict: bool = False
) -> DataFrame:
    """(symbol, ts, value): z-score of the newest row against the last ``window`` rows.

    Equals the newest row of ``rolling_zscore`` but reads one frame only. No
    rows when the panel is shorter than the window.
    """
    if window < 2:
        raise ValueError("window must be >= 2")
    if strict:
        _require_rows(panel, window, "a rolling z-score")
    found = (
        Panel(panel.last_rows(window), panel.symbols)
        .cells("x")
        .groupBy("pos")
        .agg(
            F.expr("max(ts) as ts"),
            F.expr("max_by(x, ord) as x"),
            F.expr("avg(x) as _mean"),
            F.expr("stddev_pop(x) as _sd"),
            F.expr("count(x) as _n"),
            F.expr("count(1) as _rows"),
        )
        .where(F.col("_rows") == window)
    )
    z = f"(x - _mean) / {_guarded('_sd', eps)}"
    return found.select(
        panel.symbol_at().alias("symbol"), "ts", F.expr(f"if(_n = {window}, {z}, null) as value")
    )


def scaler_params(panel: Panel, *, window: int = 60, eps: float = 1e-9) -> DataFrame:
    """(symbol, mean, scale) over the last ``window`` rows; (0, 1) if there are fewer."""
    last = Panel(panel.last_rows(window), panel.symbols)
    found = (
        last.cells()
        .groupBy("pos")
        .agg(
            F.expr("count(1) as _rows"),
            F.expr("count(value) as _n"),
            F.expr("avg(value) as _mean"),
            F.expr("stddev_pop(value) as _sd"),
        )
    )
    return found.select(
        panel.symbol_at().alias("symbol"),
        F.expr(f"case when _rows < {window} then 0D when _n = {window} then _mean end as mean"),
        F.expr(
            f"case when _rows < {window} then 1D"
            f" when _n = {window} then {_guarded('_sd', eps)} end as scale"
        ),
    )
