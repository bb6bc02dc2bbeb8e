"""``foreachBatch`` functions for bars and events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bars import retain_per_symbol
from tidemark.sinks.bar_store import persist_bars
from tidemark.sinks.reports import EVENT_TIME, event_rows

Writer = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class _Retention:
    path: str
    keep: tuple[int, ...]

    def __call__(self, bars: DataFrame, batch_id: int) -> None:
        spark = bars.sparkSession
        for size in self.keep:
            log = f"{self.path}/newest_{size}"
            held = bars
            if batch_id > 0:
                # every batch writes its logs, so those of the one before must be there
                held = spark.read.schema(bars.schema).parquet(f"{log}/batch={batch_id - 1}").unionByName(bars)
            keys = [c for c in ("source", "symbol", "bar_end") if c in bars.columns]
            single = held.groupBy(*keys).agg(
                F.max_by(F.struct(*[c for c in bars.columns if c not in keys]), "seq").alias("_bar")
            )
            rows = single.select(*keys, "_bar.*").select(*bars.columns)
            retain_per_symbol(rows, size).write.mode("overwrite").parquet(
                f"{log}/batch={batch_id}"
            )


def retention_writer(path: str, keep: tuple[int, ...] = (60, 500)) -> Writer:
    """Keep the newest bars of each symbol in one log per size.

    The bars have to be finished: a bar that a later batch adds ticks to would be
    replaced, not merged. :class:`ExactBarWriter` and its ``batch_bars`` give
    finished bars. A batch writes the logs as of that batch from those of the batch before,
    so running it again gives the same logs. Bars carry ``seq``.
    """
    if any(size < 1 for size in keep):
        raise ValueError("retention sizes must be >= 1")
    return _Retention(path, keep)


def compaction_writer(path: str) -> Writer:
    """Merge each micro-batch of bars into the hourly store; running it again is harmless."""

    def write(bars: DataFrame, batch_id: int) -> None:
        persist_bars(bars, path)

    return write


def event_writer(path: str) -> Writer:
    """Write the events of each micro-batch to its own folder of the event log."""

    def write(events: DataFrame, batch_id: int) -> None:
        event_rows(events).write.mode("overwrite").option("timestampFormat", EVENT_TIME).json(
            f"{path}/batch={batch_id}"
        )

    return write
