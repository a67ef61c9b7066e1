"""Scans."""

from tagloom.sources.scan import (
    Hook,
    dated_path,
    load_source,
    load_sources,
    read_catalog,
    read_dated,
    read_format,
    read_partitioned,
    read_tagged,
    table_exists,
)
from tagloom.sources.variant import read_tagged_variant

__all__ = [
    "Hook",
    "dated_path",
    "load_source",
    "load_sources",
    "read_catalog",
    "read_dated",
    "read_format",
    "read_partitioned",
    "read_tagged",
    "read_tagged_variant",
    "table_exists",
]
