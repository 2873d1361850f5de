"""Incremental (Structured Streaming) forms of the message load and the image enrichment."""

from chanmart.streaming.ingest_stream import enrich_stream, ingest_stream

__all__ = ["enrich_stream", "ingest_stream"]
