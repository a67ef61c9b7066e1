"""Declared schemas: column specs to StructType, and the read schema they imply."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import types as T

from tagloom.functions.names import LIST_TAG, MAP_TAG

# Declared type names and the Spark types they stand for.
_PLAIN_TYPES: dict[str, T.DataType] = {
    "varchar": T.StringType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}

# What a record has besides its image.
METADATA, KEYS, WRITTEN = "Metadata", "Keys", "WriteTimestampMicros"

SOURCE = "source"
JSON_TEXT = "json"


def schema_from_spec(columns: Iterable[Mapping[str, Any]] | T.StructType) -> T.StructType:
    """StructType of a list of ``{Name, Type, ...}`` column specs.

    ``decimal`` needs ``Precision`` and ``Scale``, ``row`` needs ``Columns``, ``array``
    needs ``Columns`` (of structs) or ``ArrayType: varchar``. Every field is nullable.
    Two optional keys serve reads without schema inference: ``Source``, the attribute
    (or dotted / listed path into nested maps) a column comes from when its name
    differs, and ``Json: true`` for arrays whose elements are JSON texts.
    """
    if isinstance(columns, T.StructType):
        return columns
    return T.StructType([_field(column, "") for column in columns])


def _field(column: Mapping[str, Any], parent: str) -> T.StructField:
    try:
        name, kind = column["Name"], column["Type"]
    except KeyError as missing:
        raise TypeError(f"column spec without {missing}: {dict(column)}") from None
    where = f"{parent}.{name}" if parent else name
    metadata: dict[str, Any] = {}
    if "Source" in column:
        source = column["Source"]
        metadata[SOURCE] = source.split(".") if isinstance(source, str) else list(source)
    if column.get("Json"):
        metadata[JSON_TEXT] = True
    return T.StructField(name, _type(column, kind, where), True, metadata)


def _type(column: Mapping[str, Any], kind: str, where: str) -> T.DataType:
    if kind in _PLAIN_TYPES:
        return _PLAIN_TYPES[kind]
    if kind == "decimal":
        if "Precision" not in column or "Scale" not in column:
            raise TypeError(f"{where}: decimal needs Precision and Scale")
        return T.DecimalType(int(column["Precision"]), int(column["Scale"]))
    if kind == "row" and "Columns" in column:
        return T.StructType([_field(child, where) for child in column["Columns"]])
    if kind == "array" and "Columns" in column:
        return T.ArrayType(T.StructType([_field(child, where) for child in column["Columns"]]))
    if kind == "array" and column.get("ArrayType") == "varchar":
        return T.ArrayType(T.StringType())
    raise TypeError(f"{where}: unsupported column spec {dict(column)}")


def source_path(field: T.StructField) -> tuple[str, ...]:
    """Attribute path a declared field is read from."""
    return tuple((field.metadata or {}).get(SOURCE) or (field.name,))


def tagged_read_schema(declared: T.StructType, root: str, keys: Iterable[str] = ()) -> T.StructType:
    """Schema to read an export with, so that no inference pass over the files is needed.

    Each attribute becomes a struct of the tags its declared type can arrive under;
    attributes that are not declared are not even parsed. With the names of ``keys`` the
    records' key struct and write time are read as well.
    """
    tree: dict[str, Any] = {}
    for field in declared.fields:
        node = tree
        *parents, last = source_path(field)
        for part in parents:
            node = node.setdefault(part, ({}, []))[0]
        node.setdefault(last, ({}, []))[1].append(field)
    image = T.StructField(root, _attributes(tree))
    named = [field for field in declared.fields if field.name in set(keys)]
    if not named:
        return T.StructType([image])
    parts = T.StructType([T.StructField(source_path(f)[-1], _tagged_node({}, [f])) for f in named])
    written = T.StructType([T.StructField(WRITTEN, T.StructType([T.StructField("N", T.StringType())]))])
    return T.StructType([T.StructField(METADATA, written), T.StructField(KEYS, parts), image])


def _attributes(tree: dict[str, Any]) -> T.StructType:
    return T.StructType([T.StructField(name, _tagged_node(*node)) for name, node in tree.items()])


def _tagged_node(children: dict[str, Any], fields: list[T.StructField]) -> T.StructType:
    tags: dict[str, T.DataType] = {}
    if children:
        tags[MAP_TAG] = _attributes(children)
    for field in fields:
        for name, kind in _tags_for(field.dataType, bool((field.metadata or {}).get(JSON_TEXT))).items():
            if name == MAP_TAG and name in tags:
                known = {f.name for f in tags[name].fields}
                kind = T.StructType(tags[name].fields + [f for f in kind.fields if f.name not in known])
            tags[name] = kind
    return T.StructType([T.StructField(name, kind) for name, kind in tags.items()])


def _tags_for(kind: T.DataType, json_elements: bool) -> dict[str, T.DataType]:
    """Tags under which values of a declared type can arrive (a NULL tag is no value)."""
    text, flag = T.StringType(), T.BooleanType()
    if isinstance(kind, T.StructType):
        nested = [(source_path(f)[-1], f) for f in kind.fields]
        return {MAP_TAG: T.StructType([T.StructField(name, _tagged_node({}, [f])) for name, f in nested])}
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType) and not json_elements:
            return {LIST_TAG: _array_of(_tags_for(kind.elementType, False))}
        elements = {"S": text, "N": text, "BOOL": flag}
        return {"SS": T.ArrayType(text), "NS": T.ArrayType(text), LIST_TAG: _array_of(elements)}
    if isinstance(kind, T.StringType):
        return {"S": text, "N": text, "BOOL": flag, "B": text}
    if isinstance(kind, T.BooleanType):
        return {"BOOL": flag, "S": text}
    return {"N": text, "S": text}


def _array_of(tags: dict[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in tags.items()]))
