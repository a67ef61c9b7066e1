"""Change records: when each was written, and which items they delete."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import column_name, quoted
from tagloom.operators.align import cast_sql
from tagloom.schema import KEYS, METADATA, WRITTEN, source_path

#: Column of the time of a change, in microseconds.
CHANGED = "change_micros"
_DELETED_AT = "__tagloom_deleted_at"


def gone_name(i: int) -> str:
    """Column of the ``i``-th key of a deleted item, as text; NULL in all other records."""
    return f"__tagloom_deleted_{i}"


def change_time(df: DataFrame) -> Column:
    """When a record was written; NULL where it does not say (snapshots need not)."""
    written = _field(df.schema[METADATA].dataType if METADATA in df.columns else None, WRITTEN)
    if written is None:
        return F.lit(None).cast("long").alias(CHANGED)
    value = F.col(quoted(METADATA)).getField(WRITTEN)
    return _scalar(value, written).try_cast("long").alias(CHANGED)


def deleted_keys(df: DataFrame, root: str, keys: Sequence[str], schema: T.StructType | None) -> list[Column]:
    """The keys of records without an image, from their key struct, as texts named by :func:`gone_name`."""
    kind = df.schema[KEYS].dataType if KEYS in df.columns else None
    if not isinstance(kind, T.StructType):
        raise ValueError(f"deletes are applied by the records' {KEYS}, which they have none of; columns are {df.columns}")
    paths = {field.name: source_path(field) for field in (schema.fields if schema is not None else [])}
    gone = F.col(quoted(root)).isNull() if root in df.columns else F.lit(True)
    found = []
    for i, key in enumerate(keys):
        name = next((f.name for f in kind.fields if (f.name,) == paths.get(key) or column_name((f.name,)) == key), None)
        if name is None:
            raise ValueError(f"no key attribute for the key column {key!r}; {KEYS} has {kind.names}")
        value = _scalar(F.col(quoted(KEYS)).getField(name), _field(kind, name))
        found.append(F.when(gone, value).alias(gone_name(i)))
    return found


def tombstones(flat: DataFrame, keys: Sequence[str], key_types: dict[str, T.DataType]) -> DataFrame:
    """One row per deleted key, in the types keys are compared in: the keys and :data:`CHANGED`, the last delete."""
    typed = []
    for i, key in enumerate(keys):
        have = flat.schema[gone_name(i)].dataType
        typed.append(F.expr(cast_sql(quoted(gone_name(i)), have, key_types.get(key, have))).alias(key))
    named = flat.where(" AND ".join(f"{gone_name(i)} IS NOT NULL" for i in range(len(keys)))).select(*typed, CHANGED)
    return named.dropna(subset=list(keys)).groupBy(*map(quoted, keys)).agg(F.max(CHANGED).alias(CHANGED))


def outliving(images: DataFrame, deleted: DataFrame, keys: Sequence[str], key_types: dict[str, T.DataType]) -> DataFrame:
    """Images that no later delete of their key removes; one written at the same time stays."""
    named = deleted.select(*[F.col(quoted(key)).alias(gone_name(i)) for i, key in enumerate(keys)], F.col(CHANGED).alias(_DELETED_AT))
    own = images.drop(*map(gone_name, range(len(keys))))
    same = [F.expr(cast_sql(quoted(key), own.schema[key].dataType, key_types.get(key, own.schema[key].dataType))) == F.col(gone_name(i)) for i, key in enumerate(keys)]
    later = F.coalesce(F.col(CHANGED) < F.col(_DELETED_AT), F.lit(True))
    return own.join(named, reduce(and_, same) & later, "left_anti")


def _field(kind: T.DataType | None, name: str) -> T.DataType | None:
    return kind[name].dataType if isinstance(kind, T.StructType) and name in kind.names else None


def _scalar(value: Column, kind: T.DataType) -> Column:
    """A scalar as text, whichever tag it is under."""
    if isinstance(kind, T.StructType):
        return F.coalesce(*[value.getField(name).cast("string") for name in kind.names])
    return value.cast("string")
