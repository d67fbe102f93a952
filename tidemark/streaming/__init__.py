"""Structured Streaming forms of replication, de-duplication and upsert."""

from tidemark.streaming.jobs import (
    ORIGIN,
    append_upserts_stream,
    dedup_stream,
    dedup_stream_with_late,
    file_stream,
    replicate_stream,
    upsert_stream,
    write_stream,
)

__all__ = [
    "ORIGIN",
    "append_upserts_stream",
    "dedup_stream",
    "dedup_stream_with_late",
    "file_stream",
    "replicate_stream",
    "upsert_stream",
    "write_stream",
]
