"""Structured Streaming forms of the loading and deduplication steps."""

from cartwright.streaming.jobs import stream_dedup_events, stream_dedup_with_late, stream_ingest, stream_upsert

__all__ = ["stream_dedup_events", "stream_dedup_with_late", "stream_ingest", "stream_upsert"]
