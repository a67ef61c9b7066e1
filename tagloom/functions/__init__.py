"""Column-level functions."""

from tagloom.functions.names import column_name, match_key
from tagloom.functions.times import (
    any_time_column,
    default_time_column,
    epoch_millis,
    epoch_seconds,
    millis_time_column,
    parse_any,
    parse_default,
    to_time_column,
)

__all__ = [
    "any_time_column",
    "column_name",
    "default_time_column",
    "epoch_millis",
    "epoch_seconds",
    "match_key",
    "millis_time_column",
    "parse_any",
    "parse_default",
    "to_time_column",
]
