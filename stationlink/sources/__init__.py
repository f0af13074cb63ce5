"""Scans, landed-file sources and sinks."""

from .tables import TABLES, read_table  # noqa: F401
