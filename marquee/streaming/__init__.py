"""Structured Streaming ingest: decode messages, de-duplicate ids, append per batch."""

from marquee.streaming.ingest import (BatchCounter, batch_sink, dedup_stream, message_stream, read_stream,
                                      start_ingest)

__all__ = ["BatchCounter", "batch_sink", "dedup_stream", "message_stream", "read_stream", "start_ingest"]
