"""Exact bars with one open bar per symbol kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import bar_volume, to_fixed
from tidemark.functions.prices import SCALE
from tidemark.session import ROCKSDB_PROVIDER

_STATE = (
    "start bigint, open double, high double, low double, close double, size double, closed boolean"
)
_OUT = (
    "source string, symbol string, start bigint, open double, high double, low double,"
    " close double, size double, late bigint"
)
_FIELDS = ["open", "high", "low", "close", "size"]


class _OpenBar(StatefulProcessor):
    """State: the open bar of a symbol, or the last one closed by the clock."""

    def __init__(self, width_us: int, wall_clock: bool) -> None:
        self.width_us = width_us
        self.wall_clock = wall_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bar = handle.getValueState("bar", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(rows)).sort_values("seq", kind="stable")
        start = ticks["start"].to_numpy()
        held = self.bar.get() if self.bar.exists() else None
        floor = held[0] if held is not None else np.iinfo(np.int64).min
        seen = np.maximum.accumulate(np.concatenate([[floor], start[:-1]]))
        late = start < seen
        if held is not None and held[6]:
            late |= start <= held[0]
        kept = ticks[~late]
        built = kept.groupby("start", sort=True).agg(
            open=("price", "first"),
            high=("price", "max"),
            low=("price", "min"),
            close=("price", "last"),
            size=("size", "sum"),
        )
        if held is not None and not held[6]:
            old = dict(zip(_FIELDS, held[1:6]))
            if held[0] in built.index:
                new = built.loc[held[0]]
                old = {
                    "open": old["open"],
                    "high": max(old["high"], new["high"]),
                    "low": min(old["low"], new["low"]),
                    "close": new["close"],
                    "size": old["size"] + new["size"],
                }
            built.loc[held[0]] = [old[f] for f in _FIELDS]
            built = built.sort_index()
        out = self._rows(key, built.iloc[:-1], int(late.sum()))
        if len(built):
            newest = built.iloc[-1]
            opened = int(built.index[-1])
            if self.wall_clock and (held is None or held[0] != opened):
                self.handle.registerTimer((opened + self.width_us) // 1000)
            self.bar.update((opened, *[float(newest[f]) for f in _FIELDS], False))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.bar.get() if self.bar.exists() else None
        if held is None or held[6] or (held[0] + self.width_us) // 1000 > expiredTimerInfo.getExpiryTimeInMs():
            yield self._rows(key, pd.DataFrame(columns=_FIELDS, dtype=float), 0)
            return
        self.bar.update((*held[:6], True))
        done = pd.DataFrame([held[1:6]], columns=_FIELDS, index=[held[0]])
        yield self._rows(key, done, 0)

    def _rows(self, key, built: pd.DataFrame, late: int) -> pd.DataFrame:
        """Finished bars; the number of late ticks rides on a row of its own."""
        out = built.rename_axis("start").reset_index()
        out["late"] = 0
        if late:
            note = {c: np.nan for c in _FIELDS} | {"start": 0, "late": late}
            out = pd.concat([out, pd.DataFrame([note])], ignore_index=True) if len(out) else pd.DataFrame([note])
        out.insert(0, "symbol", key[1])
        out.insert(0, "source", key[0])
        return out[["source", "symbol", "start", *_FIELDS, "late"]].astype(
            {"start": "int64", "late": "int64", **{f: "float64" for f in _FIELDS}}
        )

    def close(self) -> None:
        pass


def stream_bars_stateful(
    ticks: DataFrame, width: str = "1 minute", *, scale: int = SCALE, wall_clock: bool = False
) -> DataFrame:
    """Streaming bars, emitted when a tick of a later bar arrives for the symbol.

    Ticks below the symbol's open bar are dropped and counted: rows without
    prices carry ``late_ticks`` of a micro-batch. ``wall_clock`` also closes a
    bar when the clock passes its end; a closed bar is not opened again.

    One task handles a symbol's ticks of a micro-batch, so the source must bound
    the micro-batch; ``ExactBarWriter`` spreads a busy symbol over tasks.
    """
    spark = ticks.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    span = spark.range(1).select(F.window(F.lit("2020-01-01").cast("timestamp"), width).alias("w"))
    width_us = span.select(F.expr("unix_micros(w.end) - unix_micros(w.start)")).first()[0]
    placed = ticks.select(
        "source",
        "symbol",
        "seq",
        "price",
        "size",
        F.unix_micros(F.window("ts", width).getField("start")).alias("start"),
    )
    built = placed.groupBy("source", "symbol").transformWithStateInPandas(
        statefulProcessor=_OpenBar(width_us, wall_clock),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="ProcessingTime" if wall_clock else "None",
    )
    is_bar = F.col("late") == 0
    start = F.when(is_bar, F.timestamp_micros("start"))
    return built.select(
        "symbol",
        start.alias("bar_start"),
        (start + F.expr(f"interval {width}")).alias("bar_end"),
        *[to_fixed(F.col(c), scale).alias(f"{c}_fixed") for c in ("open", "high", "low", "close")],
        F.when(is_bar, bar_volume(F.col("size"))).alias("volume"),
        "source",
        F.col("late").alias("late_ticks"),
    )
