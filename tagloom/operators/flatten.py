"""Flatten: tagged, nested attributes to plain columns (F1-F8)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import MAP_TAG, NULL_TAG, column_name, quoted
from tagloom.operators.untag import Rewrite, is_tagged, merged, untag_field, untagged
from tagloom.schema import source_path

Path = tuple[str, ...]


@dataclass(frozen=True)
class _Leaf:
    """A leaf attribute. Scalars, of which wide tables have thousands, stay SQL text until
    the projection is made: building each from Column calls costs the driver far more."""

    path: Path
    kind: T.DataType
    value: str | Column


def flatten_tagged(
    df: DataFrame, root: str, schema: T.StructType | None = None, on_collision: str = "error", extra: Sequence[Column] = ()
) -> DataFrame:
    """Columns of the tagged struct ``root``: one projection, no row work in Python.

    Maps expand into one column per leaf, named by :func:`column_name`; scalars become
    text, scalar sets and lists become ``ARRAY<STRING>``, lists of maps become
    ``ARRAY<STRUCT>`` without tags. Where an attribute arrives under several tags, the
    first non-null one is taken; a NULL tag counts only if it is the attribute's only
    one, and gives a NULL text column.

    With a declared ``schema``, maps it declares as structs stay structs, and columns
    with a source attribute get their declared names.

    Different attributes whose names become one column are refused, naming them
    (``on_collision="error"``), or merged the same way (``"coalesce"``). With a declared
    schema that goes for its columns. ``extra`` columns of ``df`` are added to the projection.
    """
    if on_collision not in ("coalesce", "error"):
        raise ValueError(f"on_collision is 'coalesce' or 'error', not {on_collision!r}")
    if root not in df.columns or not isinstance(df.schema[root].dataType, T.StructType):
        raise ValueError(f"no struct column {root!r} to flatten; columns are {df.columns}")

    walk = _Walk(schema)
    groups: dict[str, list[_Leaf]] = {}
    for leaf in walk.attributes(df.schema[root].dataType, quoted(root), ()):
        for name in walk.names(leaf.path):
            groups.setdefault(name, []).append(leaf)
    if on_collision == "error":
        wanted = set(groups if schema is None else schema.names)
        paths = {name: sorted({leaf.path for leaf in group}) for name, group in groups.items() if name in wanted}
        clashes = {name: found for name, found in paths.items() if len(found) > 1}
        if clashes:
            raise ValueError(f"attributes that share a column name: {clashes}")
    return df.select(*[_column(name, group) for name, group in groups.items()], *extra)


def _column(name: str, leaves: list[_Leaf]) -> Column:
    typed = [leaf for leaf in leaves if not isinstance(leaf.kind, T.NullType)]
    if all(isinstance(leaf.value, str) for leaf in typed):
        values = [leaf.value for leaf in typed] or ["CAST(NULL AS STRING)"]
        one = values[0] if len(values) == 1 else f"coalesce({', '.join(values)})"
        return F.expr(f"{one} AS {quoted(name)}")
    columns = [F.expr(leaf.value) if isinstance(leaf.value, str) else leaf.value for leaf in typed]
    return merged(list(zip([leaf.kind for leaf in typed], columns))).alias(name)


def _leaf(path: Path, kind: T.DataType, value: str, rewrite: Rewrite) -> _Leaf:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        result, expression = rewrite
        return _Leaf(path, result, expression(F.expr(value)))
    return _Leaf(path, T.StringType(), value if isinstance(kind, T.StringType) else f"CAST({value} AS STRING)")


class _Walk:
    """Walk over the struct type; attributes and tags alternate by position, so an
    attribute that happens to be called like a tag keeps its name."""

    def __init__(self, declared: T.StructType | None) -> None:
        fields = declared.fields if declared is not None else []
        self._declared: dict[Path, list[str]] = {}
        for field in fields:
            self._declared.setdefault(source_path(field), []).append(field.name)
        self._taken = {f.name for f in fields if source_path(f) != (f.name,)}
        self._rows = {f.name for f in fields if isinstance(f.dataType, T.StructType)}

    def names(self, path: Path) -> list[str]:
        """Columns an attribute goes to: those that name it as their source; else the one
        its path makes, unless that one names another source."""
        made = column_name(path)
        return self._declared.get(path) or ([] if made in self._taken else [made])

    def attributes(self, struct: T.StructType, value: str, path: Path) -> Iterator[_Leaf]:
        for field in struct.fields:
            under = f"{value}.{quoted(field.name)}"
            yield from self._attribute(field.dataType, under, (*path, field.name))

    def _attribute(self, kind: T.DataType, value: str, path: Path) -> Iterator[_Leaf]:
        if is_tagged(kind):
            typed = [f for f in kind.fields if f.name != NULL_TAG]
            if not typed:
                yield _Leaf(path, T.NullType(), value)
            for field in typed:
                under = f"{value}.{quoted(field.name)}"
                if field.name == MAP_TAG and isinstance(field.dataType, T.StructType):
                    yield from self._map(field, under, path)
                else:
                    yield _leaf(path, field.dataType, under, untag_field(field))
        elif isinstance(kind, T.StructType):
            yield from self.attributes(kind, value, path)
        else:
            yield _leaf(path, kind, value, untagged(kind))

    def _map(self, field: T.StructField, value: str, path: Path) -> Iterator[_Leaf]:
        below = self.attributes(field.dataType, value, path)
        if not self._rows.intersection(self.names(path)):
            yield from below
            return
        yield _leaf(path, field.dataType, value, untag_field(field))
        # parts of a declared map that are declared as columns of their own as well
        columns = {name for names in self._declared.values() for name in names}
        yield from (leaf for leaf in below if columns.intersection(self.names(leaf.path)))
