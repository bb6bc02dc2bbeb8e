"""Readers and message decoders."""

from tidemark.sources.feeds import decode_array_feed, decode_object_feed
from tidemark.sources.files import (
    parse_bar_log,
    read_bar_store,
    read_price_panel,
    read_run_history,
)

__all__ = [
    "decode_array_feed",
    "decode_object_feed",
    "parse_bar_log",
    "read_bar_store",
    "read_price_panel",
    "read_run_history",
]
