"""Structured Streaming jobs."""

from paydw.streaming.ingest import staging_stream
from paydw.streaming.live import live_daily_totals, live_sessions, read_latest_totals, snapshot_totals, split_late

__all__ = ["live_daily_totals", "live_sessions", "split_late", "read_latest_totals", "snapshot_totals", "staging_stream"]
