"""The two chains of operators."""

from tidemark.plans.build import build_panel
from tidemark.plans.snapshot import live_snapshot

__all__ = ["build_panel", "live_snapshot"]
