"""Tumbling bars under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bar_volume, to_fixed
from tidemark.functions.prices import SCALE


def stream_bars(
    ticks: DataFrame, width: str = "1 minute", watermark: str = "0 seconds", *, scale: int = SCALE
) -> DataFrame:
    """Streaming OHLCV bars, for append mode.

    A bar is emitted once the watermark passes its end, over all symbols, and
    later ticks for it are dropped (``numRowsDroppedByWatermark`` counts them).
    The watermark moves between micro-batches, so ticks that are late within
    one still count; ``ExactBarWriter`` drops those too. Partial bars are formed
    before the shuffle, which keeps a busy symbol cheap.
    """
    built = (
        ticks.withWatermark("ts", watermark)
        .groupBy(F.window("ts", width).alias("w"), "symbol", "source")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("size").alias("size"),
        )
    )
    return built.select(
        "symbol",
        F.col("w.start").alias("bar_start"),
        F.col("w.end").alias("bar_end"),
        *[to_fixed(F.col(c), scale).alias(f"{c}_fixed") for c in ("open", "high", "low", "close")],
        bar_volume(F.col("size")).alias("volume"),
        "source",
    )
