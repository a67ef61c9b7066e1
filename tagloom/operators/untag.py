"""Expressions that take type tags off a value of any depth.

A tagged value is a struct whose fields are type tags, one of them set. The Spark
type alone says what is tagged, so the rewriting is decided once on the driver and
the result is one JVM expression per column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import LIST_TAG, MAP_TAG, NULL_TAG, SET_TAGS, TAGS

Rewrite = tuple[T.DataType, Callable[[Column], Column]]


def is_tagged(kind: T.DataType) -> bool:
    """Whether a value of this type is a tagged value."""
    return isinstance(kind, T.StructType) and len(kind) > 0 and set(kind.names) <= TAGS


def same_type(left: T.DataType, right: T.DataType) -> bool:
    """Type equality that ignores nullability and metadata."""
    return left.simpleString() == right.simpleString()


def untagged(kind: T.DataType) -> Rewrite:
    """Type and expression of a value without its tags: scalars as text, ``M`` as a
    struct, ``L`` and sets as arrays, recursively."""
    if is_tagged(kind):
        return _tagged(kind)
    if isinstance(kind, T.StructType):
        return _struct(kind)
    if isinstance(kind, T.ArrayType):
        return array_of_untagged(kind)
    if isinstance(kind, (T.StringType, T.MapType)):
        return kind, lambda value: value
    return T.StringType(), lambda value: value.cast("string")


def array_of_untagged(kind: T.ArrayType) -> Rewrite:
    """Array of structs without tags; arrays of scalars stay as they are.

    An element that is no map, in a list of maps, becomes a struct of NULLs.
    """
    if not isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return kind, lambda value: value
    fields = element_fields(kind)
    if fields is not None:
        return _zipped(fields)
    inside, _ = map_element(kind.elementType)
    element, rewrite = untagged(kind.elementType)
    return T.ArrayType(element), lambda value: F.transform(value, lambda x: rewrite(inside(x)))


def map_element(kind: T.DataType) -> tuple[Callable[[Column], Column], T.StructType | None]:
    """How to get from a list element (or a whole list) to the struct of its attributes,
    and that struct's type; no type if the element is not simply a map."""
    if not is_tagged(kind):
        return lambda x: x, kind if isinstance(kind, T.StructType) else None
    typed = [f for f in kind.fields if f.name != NULL_TAG]
    if [f.name for f in typed] == [MAP_TAG] and isinstance(typed[0].dataType, T.StructType):
        return lambda x: x.getField(MAP_TAG), typed[0].dataType
    return lambda x: x, None


@dataclass(frozen=True)
class ElementField:
    """A field of the maps in a list: its type, without the tag if it has only one, how to get
    the array of its values, and a value's type and expression without tags."""

    kind: T.DataType
    take: Callable[[Column], Column]
    rewrite: Rewrite

    @property
    def scalar(self) -> bool:
        return not isinstance(self.kind, (T.StructType, T.ArrayType, T.MapType))


def element_fields(kind: T.ArrayType) -> dict[str, ElementField] | None:
    """The fields of a list of maps by name; None if its elements are not simply maps.

    Taking fields out of a whole array and zipping them again is compiled code, unlike
    ``transform``, whose lambda is interpreted for every element: about ten times as fast. So a
    list is rewritten field by field: those of scalars under one tag as whole arrays, only the
    others (unions, maps, lists) by a lambda, over their own values. In it a list is
    rewritten as a whole again.
    """
    inside, body = map_element(kind.elementType)
    if body is None or len(body) == 0:
        return None
    fields: dict[str, ElementField] = {}
    for field in body.fields:
        inner, steps, rewrite = field.dataType, [field.name], None
        if is_tagged(inner):
            typed = [f for f in inner.fields if f.name != NULL_TAG]
            if len(typed) == 1:
                inner, rewrite = typed[0].dataType, untag_field(typed[0])
                steps.append(typed[0].name)
        take = lambda value, steps=steps: reduce(Column.getField, steps, inside(value))
        fields[field.name] = ElementField(inner, take, rewrite or untagged(inner))
    return fields


def _zipped(fields: dict[str, ElementField]) -> Rewrite:
    def rewrite(value: Column) -> Column:
        return F.arrays_zip(*[_whole(field, field.take(value)).alias(name) for name, field in fields.items()])

    kinds = {name: T.StringType() if field.scalar else field.rewrite[0] for name, field in fields.items()}
    return T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])), rewrite


def _whole(field: ElementField, array: Column) -> Column:
    """The array of a field's values without tags."""
    if field.scalar:
        return array if isinstance(field.kind, T.StringType) else array.cast("array<string>")
    result, rewrite = field.rewrite
    return array if same_type(result, field.kind) else F.transform(array, rewrite)


def merged_type(kinds: list[T.DataType]) -> T.DataType:
    """Type of :func:`merged` values: their common type, else text."""
    return kinds[0] if all(same_type(kinds[0], kind) for kind in kinds) else T.StringType()


def merged(options: list[tuple[T.DataType, Column]]) -> Column:
    """One value from several of which at most one is set, the first set one winning.

    Options of different types have only text in common: texts stay, the rest becomes
    JSON text, so nothing is lost.
    """
    if len(options) == 1:
        return options[0][1]
    common = merged_type([kind for kind, _ in options])
    return F.coalesce(*[v if same_type(k, common) else F.to_json(v) for k, v in options])


def _tagged(kind: T.StructType) -> Rewrite:
    fields = [f for f in kind.fields if f.name != NULL_TAG]
    if not fields:
        return T.StringType(), lambda value: F.lit(None).cast("string")
    rewrites = [(f.name, *untag_field(f)) for f in fields]

    def rewrite(value: Column) -> Column:
        return merged([(k, fn(value.getField(tag))) for tag, k, fn in rewrites])

    return merged_type([k for _, k, _ in rewrites]), rewrite


def untag_field(field: T.StructField) -> Rewrite:
    """Type and expression of what sits under one tag."""
    kind = field.dataType
    if field.name == MAP_TAG and isinstance(kind, T.StructType):
        return _struct(kind)
    if field.name in (LIST_TAG, *SET_TAGS) and isinstance(kind, T.ArrayType):
        return array_of_untagged(kind)
    return untagged(kind) if isinstance(kind, (T.StructType, T.ArrayType)) else _text(kind)


def _text(kind: T.DataType) -> Rewrite:
    if isinstance(kind, T.StringType):
        return kind, lambda value: value
    return T.StringType(), lambda value: value.cast("string")


def _struct(kind: T.StructType) -> Rewrite:
    rewrites = [(f.name, *untagged(f.dataType)) for f in kind.fields]
    result = T.StructType([T.StructField(name, k) for name, k, _ in rewrites])

    def rewrite(value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(*[fn(value.getField(name)).alias(name) for name, _, fn in rewrites]))

    return result, rewrite
