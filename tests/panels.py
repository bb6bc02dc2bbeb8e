"""Panels for tests, from and to wide pandas frames."""

import numpy as np
import pandas as pd

from tidemark.panel import Panel, densify


def long_frame(spark, wide: pd.DataFrame):
    rows = [
        (symbol, ts.to_pydatetime(), None if np.isnan(value) else float(value))
        for ts, row in wide.iterrows()
        for symbol, value in row.items()
    ]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, price double")


def panel_of(spark, wide: pd.DataFrame) -> Panel:
    return densify(long_frame(spark, wide), list(wide.columns))


def to_wide(panel: Panel) -> pd.DataFrame:
    rows = sorted(panel.rows.collect(), key=lambda r: r.ord)
    assert [r.ord for r in rows] == list(range(len(rows)))
    data = [[np.nan if v is None else v for v in r["values"]] for r in rows]
    return pd.DataFrame(
        data, index=pd.DatetimeIndex([r.ts for r in rows]), columns=list(panel.symbols), dtype=float
    )


def tidy_to_wide(df, value: str, symbols) -> pd.DataFrame:
    pdf = df.toPandas()
    return pdf.pivot(index="ts", columns="symbol", values=value).reindex(columns=list(symbols))


def days(n: int) -> pd.DatetimeIndex:
    return pd.date_range("2025-01-01", periods=n, freq="B")


def prices(n: int, symbols, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    walk = rng.normal(0, 0.02, (n, len(symbols))).cumsum(axis=0)
    return pd.DataFrame(100 * np.exp(walk), index=days(n), columns=list(symbols))
