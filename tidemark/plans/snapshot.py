"""The newest bars to z-scores, residuals and factor shares."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.operators.bars import close_panel
from tidemark.operators.factors import explained_variance, residual_zscore
from tidemark.operators.returns import latest_zscore, log_returns, rolling_zscore
from tidemark.panel import Panel, ordered_unique


def live_snapshot(
    bar_log: DataFrame,
    universe: Iterable[str],
    lookback: int = 500,
    z_window: int = 60,
    pca_components: int = 3,
) -> dict[str, Panel | DataFrame]:
    """Close panel of the last ``lookback`` returns and everything derived from it.

    ``lookback`` returns need one more close. The factor shares are those of
    the last ``z_window`` z-scores. The close, return and z-score panels are written
    once to the shared working folder, since several results read them.
    """
    if lookback < z_window:
        raise ValueError("lookback must be >= z_window")
    names = ordered_unique(universe)
    closes = close_panel(bar_log, names, lookback + 1).stored("closes")
    returns = log_returns(closes).stored("returns")
    scores = rolling_zscore(returns, window=z_window, eps=1e-12, drop_partial=True).stored("zscores")
    return {
        "close": closes,
        "log_returns": returns,
        "zscores": scores,
        "latest_zscore": latest_zscore(returns, window=z_window),
        "latest_residual_zscore": residual_zscore(returns, window=lookback, factors=1),
        "explained_variance": explained_variance(
            scores, window=z_window, n_components=min(pca_components, len(names))
        ),
    }
