"""Writers."""

from tidemark.sinks.bar_store import PersistResult, persist_bars
from tidemark.sinks.reports import (
    append_events,
    build_metadata,
    feed_report,
    outlier_report,
    read_current,
    write_csv,
    write_json,
    write_run,
)

__all__ = [
    "PersistResult",
    "append_events",
    "build_metadata",
    "feed_report",
    "outlier_report",
    "persist_bars",
    "read_current",
    "write_csv",
    "write_json",
    "write_run",
]
