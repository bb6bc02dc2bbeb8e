"""Structured Streaming: bars, retention, compaction and the event log."""

from tidemark.streaming.bars import stream_bars
from tidemark.streaming.exact import (
    CountingWriter,
    ExactBarWriter,
    batch_bars,
    batch_counters,
    read_counters,
    read_exact_bars,
    read_late_ticks,
)
from tidemark.streaming.stateful import stream_bars_stateful
from tidemark.streaming.writers import compaction_writer, event_writer, retention_writer

__all__ = [
    "CountingWriter",
    "ExactBarWriter",
    "batch_bars",
    "batch_counters",
    "compaction_writer",
    "event_writer",
    "read_counters",
    "read_exact_bars",
    "read_late_ticks",
    "retention_writer",
    "stream_bars",
    "stream_bars_stateful",
]
