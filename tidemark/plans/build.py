"""Prices to a standardised panel with its reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.operators.cleaning import fill_gaps, replace_zombies
from tidemark.operators.correlation import correlation, correlation_outliers
from tidemark.operators.returns import log_returns, rolling_zscore, scaler_params
from tidemark.panel import Panel, densify, ordered_unique


def build_panel(
    prices: DataFrame,
    primaries: Iterable[str],
    reserves: Iterable[str],
    threshold: float = 0.05,
    *,
    window: int = 60,
    low_threshold: float = 0.3,
    require_healthy: bool = False,
    store: bool = True,
) -> dict[str, Panel | DataFrame]:
    """clean -> fill -> returns -> z-scores -> correlation, from tidy prices.

    The replacement table, at most one row per primary, is read on the way.
    ``store`` writes each intermediate panel once to the shared working folder;
    without it the results are one lazy plan each, all from the prices up.
    """
    def settled(panel: Panel, label: str) -> Panel:
        return panel.stored(label) if store else panel

    first = ordered_unique(primaries)
    raw = settled(densify(prices, [*first, *reserves]), "prices")
    clean, replacements = replace_zombies(
        raw, first, reserves, threshold=threshold, require_healthy=require_healthy
    )
    filled = settled(fill_gaps(clean), "filled")
    returns = settled(log_returns(filled), "returns")
    scores = settled(rolling_zscore(returns, window=window), "zscores")
    pairs = correlation(scores)
    return {
        "prices": filled,
        "replacements": replacements,
        "log_returns": returns,
        "zscores": scores,
        "scaler_params": scaler_params(returns, window=window),
        "correlation": pairs,
        "outliers": correlation_outliers(pairs, low_threshold=low_threshold),
    }
