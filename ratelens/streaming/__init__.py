"""Structured Streaming form of the per-item aggregation."""

from ratelens.streaming.incremental import current_item_stats, start_item_stats

__all__ = ["current_item_stats", "start_item_stats"]
