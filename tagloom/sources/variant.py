"""Tagged exports read once without a declared schema, by way of variant values."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import quoted
from tagloom.schema import KEYS, METADATA
from tagloom.scratch import staged

# How a variant's schema is spelled; names are followed by a colon.
_SPELLING = re.compile(r"`(?:[^`]|``)*`|(?P<name>\w+): |(?P<object>OBJECT<)|(?P<void>\bVOID\b)|(?P<any>\bVARIANT\b)")


def read_tagged_variant(
    spark: SparkSession, paths: str | Sequence[str], root: str, options: Mapping[str, Any] | None = None
) -> DataFrame:
    """JSON-lines export files of unknown attributes, parsed once.

    Each line becomes a variant; the ``root`` struct's, the keys' and the metadata's are
    staged. Their types are then merged over the staged values, and the values taken out by them. The
    result has the columns and types that Spark's inference gives, which parses the text twice:
    a value that is of different types in different records is text, JSON text if it is no
    scalar; numbers with a fraction are doubles; empty structs are left out. Lines that are no
    JSON are NULLs, and objects in JSON text have their names in order and no blanks.

    The staged folder (``staged_path`` of the result) is its owner's to delete, once the rows
    are read.
    """
    lines = spark.read.options(**dict(options or {})).option("singleVariantColumn", "record").json(paths)
    parts = [F.try_variant_get("record", "$" + _step(name), "variant").alias(name) for name in (root, KEYS, METADATA)]
    held, path = staged(lines.select(*parts), "variant", with_path=True)
    spelled = held.agg(*[F.schema_of_variant_agg(quoted(name)).alias(name) for name in held.columns]).first()
    found = {name: inferred_type(spelled[name]) for name in held.columns}
    columns = [_taken(name, kind) for name, kind in found.items() if kind is not None]
    records = held.select(*columns)
    records.staged_path = path
    return records


def inferred_type(spelled: str | None) -> T.DataType | None:
    """The Spark type of a variant's schema; None for an object without any fields, or no value at all."""

    def sql(found: re.Match) -> str:
        if found["name"]:
            return f"{quoted(found['name'])}: "
        if found["object"]:
            return "STRUCT<"
        return "STRING" if found["void"] or found["any"] else found[0]

    return _kept(T.DataType.fromDDL(_SPELLING.sub(sql, spelled))) if spelled and spelled != "VOID" else None


def _kept(kind: T.DataType) -> T.DataType | None:
    """The type without empty structs, as inference leaves them out; fractions are doubles."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, inner) for f in kind.fields if (inner := _kept(f.dataType)) is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        inner = _kept(kind.elementType)
        return T.ArrayType(inner) if inner is not None else None
    return T.DoubleType() if isinstance(kind, T.DecimalType) and kind.scale > 0 else kind


def _taken(name: str, kind: T.DataType) -> Column:
    return F.try_variant_get(quoted(name), "$", type_sql(kind)).alias(name)


def type_sql(kind: T.DataType) -> str:
    """A type as SQL that holds any field names."""
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'{quoted(f.name)}: {type_sql(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{type_sql(kind.elementType)}>"
    return kind.simpleString()


def _step(name: str) -> str:
    return f"['{name}']" if not name.isidentifier() else f".{name}"
