"""Readers and sinks."""

from voxloom.sources.tables import table

__all__ = ["table"]
