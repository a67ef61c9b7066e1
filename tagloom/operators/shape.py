"""Row filters, latest row per key, projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import listing, quoted
from tagloom.operators.align import cast_sql

_RANK = "__tagloom_rank"


def keep_keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all non-null."""
    return df.where(" AND ".join(f"{quoted(key)} IS NOT NULL" for key in keys)) if keys else df


def total_order(df: DataFrame, but: Iterable[str] = ()) -> list[str]:
    """Columns that can break ties, by name: everything that can be ordered."""
    skip = set(but)
    return sorted(f.name for f in df.schema.fields if f.name not in skip and _orderable(f.dataType))


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def descending(names: Iterable[str]) -> str:
    """The names as an ORDER BY list, greatest first and NULLs last."""
    return listing(names, " DESC NULLS LAST")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | None,
    *,
    order_type: T.DataType | None = None,
    tiebreak: Sequence[str] | None = None,
    key_types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_by`` per key; NULLs are lowest.

    ``order_type`` is the type to compare ``order_by`` in (a number text sorts as text
    otherwise). Ties go to the greatest ``tiebreak`` columns; by default all other
    columns count, so that a task run again after a lost executor picks the same row.
    ``key_types`` are types to compare keys in (``7`` and ``07`` are one number); texts that
    do not fit their type stay apart from each other. Without keys or an order column, ``df`` as it is.

    Spark keeps the best row per key before the shuffle as well as after it, so a key
    that holds a large part of the input sends at most one row per map task.
    """
    if not keys or not order_by:
        return df
    order = quoted(order_by)
    if order_type is not None:
        order = cast_sql(order, df.schema[order_by].dataType, order_type)
    if tiebreak is None:
        compared = [key for key in keys if key not in (key_types or {})]
        tiebreak = total_order(df, but=(*compared, *(() if order_type is not None else (order_by,))))
    ordering = ", ".join(filter(None, [f"{order} DESC NULLS LAST", descending(tiebreak)]))
    groups = []
    for key in keys:
        kind, text = df.schema[key].dataType, quoted(key)
        cast = cast_sql(text, kind, key_types[key]) if key_types and key in key_types else text
        groups += [cast] if cast == text else [cast, f"CASE WHEN {cast} IS NULL THEN {text} END"]
    return best_row(df, groups, ordering)


def best_row(df: DataFrame, groups: Sequence[str], ordering: str) -> DataFrame:
    """The first row per group of SQL expressions in the given ORDER BY list."""
    rank = F.expr(f"row_number() OVER (PARTITION BY {', '.join(groups)} ORDER BY {ordering})")
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def surrogate_id(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """``name`` = the keys joined by ``-``, if there are at least two."""
    if len(keys) < 2:
        return df
    return df.withColumn(name, F.concat_ws("-", *map(quoted, keys)))


def post_filters(df: DataFrame, conditions: Iterable[str]) -> DataFrame:
    """SQL conditions, all of which a row has to meet."""
    return reduce(lambda d, condition: d.where(condition), conditions, df)


def rename_columns(df: DataFrame, renames: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """Renames in order; names that are absent are passed over."""
    pairs = renames.items() if isinstance(renames, Mapping) else renames
    return reduce(lambda d, pair: d.withColumnRenamed(*pair), pairs, df)


def sql_columns(df: DataFrame, columns: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """SQL expression columns in order, each seeing those before it.

    New columns that follow each other are one projection, in which an expression may name
    the aliases before it; a column that replaces another is a projection of its own, as
    an alias would not hide the column it replaces. So hundreds of them are analysed at once.
    """
    pairs = list(columns.items() if isinstance(columns, Mapping) else columns)
    while pairs:
        names = {name.lower() for name in df.columns}
        new = []
        for name, sql in pairs:
            if name.lower() in names:
                break
            names.add(name.lower())
            new.append((name, sql))
        if new:
            df = _with_new(df, new)
        else:
            name, sql = pairs[0]
            df = df.withColumn(name, F.expr(sql))
        pairs = pairs[max(len(new), 1) :]
    return df


def _with_new(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    try:
        return df.select("*", *[F.expr(sql).alias(name) for name, sql in pairs])
    except AnalysisException:
        # a window over an alias, say; or a mistake, which is then named without the others
        return reduce(lambda d, pair: d.withColumn(pair[0], F.expr(pair[1])), pairs, df)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns in that order; all of them if none are named (P5)."""
    return df.select(*map(quoted, names)) if names else df


def sorted_projection(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return select_columns(df, sorted(df.columns))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """The number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row; reads until the first one only."""
    return df.isEmpty()
