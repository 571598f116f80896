"""Incremental (Structured Streaming) form of the long-form core."""

from stayframe.streaming.window_stats import start_window_stats, stream_rows  # noqa: F401
