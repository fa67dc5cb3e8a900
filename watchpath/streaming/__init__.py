"""Incremental refresh of the attributed store and of the viewing history from growing source tables."""

from watchpath.streaming.daily import refresh_attributed
from watchpath.streaming.history import load_history, merge_viewings, refresh_history

__all__ = ["load_history", "merge_viewings", "refresh_attributed", "refresh_history"]
