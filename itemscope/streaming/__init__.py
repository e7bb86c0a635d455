"""Incremental (Structured Streaming) forms of the cleaning and per-item statistics."""

from itemscope.streaming.incremental import interaction_stream, latest_stats, rating_stats_stream, start_rating_stats

__all__ = ["interaction_stream", "latest_stats", "rating_stats_stream", "start_rating_stats"]
