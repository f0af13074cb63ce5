"""Incremental loads with Structured Streaming (file source + checkpoint)."""

from .incremental import incremental_load, landed_until  # noqa: F401
