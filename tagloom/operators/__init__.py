"""DataFrame operators."""

from tagloom.operators.align import align, cast_to
from tagloom.operators.flatten import flatten_tagged
from tagloom.operators.metadata import add_metadata, utc_to_local
from tagloom.operators.rejects import split_rejects
from tagloom.operators.shape import (
    is_empty,
    keep_keyed,
    latest_per_key,
    post_filters,
    rename_columns,
    row_count,
    select_columns,
    sorted_projection,
    sql_columns,
    surrogate_id,
)

__all__ = [
    "add_metadata",
    "align",
    "cast_to",
    "flatten_tagged",
    "is_empty",
    "keep_keyed",
    "latest_per_key",
    "post_filters",
    "rename_columns",
    "row_count",
    "select_columns",
    "sorted_projection",
    "split_rejects",
    "sql_columns",
    "surrogate_id",
    "utc_to_local",
]
