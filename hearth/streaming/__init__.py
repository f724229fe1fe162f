"""Incremental file pickup with Structured Streaming."""

from hearth.streaming.ingest import ingest_available, landed_stream, stream_insert_ignore

__all__ = ["ingest_available", "landed_stream", "stream_insert_ignore"]
