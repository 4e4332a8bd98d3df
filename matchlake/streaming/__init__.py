"""Structured Streaming delivery of the keyed battle-log load."""

from .ingest import stream_insert_ignore  # noqa: F401
