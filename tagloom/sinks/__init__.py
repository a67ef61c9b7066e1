"""Sinks."""

from tagloom.sinks.merge import apply_changes, read_upserted, upsert
from tagloom.sinks.write import write_files, write_partitioned, write_table

__all__ = ["apply_changes", "read_upserted", "upsert", "write_files", "write_partitioned", "write_table"]
