"""Align: any DataFrame to a declared schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import MAP_TAG, NULL_TAG, match_key, quoted
from tagloom.functions.times import epoch_seconds
from tagloom.operators.rejects import REJECT_LIST, all_of, rejected_elements, rejected_value
from tagloom.operators.untag import ElementField, element_fields, is_tagged, map_element, same_type, untagged
from tagloom.schema import source_path

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def align(df: DataFrame, schema: T.StructType, strict: bool = False, rejects: str | None = None) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, in its order.

    Columns that are missing become typed NULLs, others are dropped. Values that do
    not fit their type become NULL, or end the job if ``strict``. Structs and arrays
    of structs are rebuilt field by field; inside them names match regardless of case
    and underscores, tagged values lose their tags, JSON texts are parsed, and digits
    for a timestamp are epoch seconds.

    ``rejects`` names one more column, for the values that became NULL because they do not
    fit: a list of (name, raw, wanted), empty where all fit. Names are paths, as ``items[2].price``;
    ``raw`` is the value as text. The other columns are the same with it and without.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    columns = [_column(f.name, have.get(f.name), f.dataType, strict) for f in schema.fields]
    if rejects is None:
        return df.select(*columns)
    if rejects in schema.names:
        raise ValueError(f"the schema has a column {rejects!r} already")
    lists = [rejected(F.lit(f.name), F.col(quoted(f.name)), have[f.name], f.dataType) for f in schema.fields if f.name in have]
    found = [each for each in lists if each is not None] or [F.array().cast(REJECT_LIST)]
    return df.select(*columns, F.concat(*found).alias(rejects))


def _column(name: str, have: T.DataType | None, want: T.DataType, strict: bool) -> Column:
    if have is not None and (isinstance(have, _NESTED) or isinstance(want, _NESTED)):
        return _aligned(F.col(quoted(name)), have, want, strict, False).alias(name)
    if have is not None:
        return F.expr(f"{cast_sql(quoted(name), have, want, strict)} AS {quoted(name)}")
    return F.lit(None).cast(want).alias(name)


def cast_sql(value: str, have: T.DataType, want: T.DataType, strict: bool = False) -> str:
    """:func:`cast_to` as SQL text, for the scalar columns of wide tables."""
    kind = want.simpleString()
    if same_type(have, want):
        return value
    if strict:
        return f"CAST({value} AS {kind})"
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        return f"coalesce(try_cast({value} AS {kind}), try_cast(try_cast({value} AS decimal(38,18)) AS {kind}))"
    return f"try_cast({value} AS {kind})"


def cast_to(value: Column, have: T.DataType, want: T.DataType, strict: bool = False) -> Column:
    """Scalar cast that yields NULL for what does not fit.

    Number texts with a fraction or an exponent still fit integers (fraction cut off),
    as attribute numbers are decimal texts of any notation.
    """
    if same_type(have, want):
        return value
    if strict:
        return value.cast(want)
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        return F.coalesce(value.try_cast(want), value.try_cast("decimal(38,18)").try_cast(want))
    return value.try_cast(want)


def _aligned(value: Column, have: T.DataType, want: T.DataType, strict: bool, nested: bool) -> Column:
    if same_type(have, want):
        return value
    if is_tagged(have):
        return _from_tagged(value, have, want, strict)
    if isinstance(have, T.StringType) and isinstance(want, (T.StructType, T.ArrayType)):
        return _from_json(value, want, strict)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        return _rebuilt(value, have, want, strict)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return _elements(value, have, want.elementType, strict)
    if nested and isinstance(want, T.TimestampType) and not isinstance(have, _NESTED):
        return F.coalesce(epoch_seconds(value.cast("string")), cast_to(value, have, want, strict))
    return cast_to(value, have, want, strict)


def _from_tagged(value: Column, have: T.StructType, want: T.DataType, strict: bool) -> Column:
    typed = [f for f in have.fields if f.name != NULL_TAG]
    if isinstance(want, T.StructType) and [f.name for f in typed] == [MAP_TAG]:
        return _aligned(value.getField(MAP_TAG), typed[0].dataType, want, strict, True)
    kind, rewrite = untagged(have)
    return _aligned(rewrite(value), kind, want, strict, True)


def _matches(have: list[str], want: T.StructType) -> dict[str, str]:
    """Which of the names ``have`` each wanted field comes from, where one does."""
    loose = {match_key(name): name for name in reversed(have)}
    found = {}
    for target in want.fields:
        origin = source_path(target)[-1]
        exact = next((name for name in (origin, target.name) if name in have), None)
        found[target.name] = exact or loose.get(match_key(target.name))
    return {name: source for name, source in found.items() if source is not None}


def _fields(value: Column, have: T.StructType, want: T.StructType, strict: bool) -> Column:
    found = _matches(have.names, want)
    return F.struct(
        *[
            _aligned(value.getField(found[f.name]), have[found[f.name]].dataType, f.dataType, strict, True).alias(f.name)
            if f.name in found
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
    )


def _rebuilt(value: Column, have: T.StructType, want: T.StructType, strict: bool) -> Column:
    return F.when(value.isNotNull(), _fields(value, have, want, strict))


def _elements(value: Column, have: T.ArrayType, want: T.DataType, strict: bool) -> Column:
    element = have.elementType
    if same_type(element, want):
        return value
    if isinstance(want, T.StructType):
        if isinstance(element, T.StringType):
            text = _text_type(want)
            parsed = F.transform(value, lambda x: F.from_json(x, text))
            return _elements(parsed, T.ArrayType(text), want, strict)
        zipped = _zipped(value, have, want, strict)
        if zipped is not None:
            return zipped
        inside, body = map_element(element)
        if body is not None:
            return F.transform(value, lambda x: _fields(inside(x), body, want, strict))
    return F.transform(value, lambda x: _aligned(x, element, want, strict, True))


def _zipped(value: Column, have: T.ArrayType, want: T.StructType, strict: bool) -> Column | None:
    """A list of maps rebuilt from arrays of its fields (see :func:`element_fields` for why),
    those that can be cast as whole arrays without a lambda; None if it is no list of maps."""
    fields = element_fields(have)
    found = _matches(list(fields or ()), want)
    if not found:
        return None
    arrays = []
    for target in want.fields:
        if target.name not in found:
            # zipping fills up the shorter array with NULLs
            arrays.append(F.array().cast(T.ArrayType(target.dataType)).alias(target.name))
            continue
        field = fields[found[target.name]]
        arrays.append(_whole(field, field.take(value), target.dataType, strict).alias(target.name))
    return F.arrays_zip(*arrays)


def _whole(field: ElementField, array: Column, want: T.DataType, strict: bool) -> Column:
    """The array of a field's values, aligned."""
    if field.scalar and not isinstance(want, (*_NESTED, T.TimestampType)):
        return _cast_array(array, field.kind, want, strict)
    if isinstance(field.kind, T.StructType) and not is_tagged(field.kind) and not isinstance(want, T.StructType):
        kind, rewrite = untagged(field.kind)
        return F.transform(array, lambda x: _aligned(rewrite(x), kind, want, strict, True))
    return F.transform(array, lambda x: _aligned(x, field.kind, want, strict, True))


def _cast_array(value: Column, have: T.DataType, want: T.DataType, strict: bool) -> Column:
    """:func:`cast_to` for all elements at once."""
    if same_type(have, want):
        return value
    if strict:
        return value.cast(T.ArrayType(want))
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        value = value.try_cast("array<decimal(38,18)>")
    return value.try_cast(T.ArrayType(want))


def _from_json(value: Column, want: T.DataType, strict: bool) -> Column:
    text = _text_type(want)
    return _once(F.from_json(value, text), lambda x: _aligned(x, text, want, strict, True))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once however often ``use`` mentions it."""
    return F.transform(F.array(value), use).getItem(0)


def _text_type(kind: T.DataType) -> T.DataType:
    """``kind`` with text for every scalar: JSON is read as text and cast afterwards, so
    that ``3`` and ``"3"`` both fit a number and one bad field spoils only itself."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(source_path(f)[-1], _text_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_text_type(kind.elementType))
    return T.StringType()


# --- values that do not fit ------------------------------------------------------------------


def rejected(name: Column, value: Column, have: T.DataType, want: T.DataType, nested: bool = False) -> Column | None:
    """The list of what :func:`align` makes NULL because it does not fit; None if everything fits.

    ``name`` is the path of ``value``. The cases are those of aligning a value.
    """
    if same_type(have, want):
        return None
    if is_tagged(have):
        typed = [f for f in have.fields if f.name != NULL_TAG]
        if isinstance(want, T.StructType) and [f.name for f in typed] == [MAP_TAG]:
            return rejected(name, value.getField(MAP_TAG), typed[0].dataType, want, True)
        kind, rewrite = untagged(have)
        return rejected(name, rewrite(value), kind, want, True)
    if isinstance(have, T.StringType) and isinstance(want, (T.StructType, T.ArrayType)):
        text = _text_type(want)
        inside = rejected(name, F.from_json(value, text), text, want, True)
        whole = rejected_value(name, value, F.try_parse_json(value), want)
        return whole if inside is None else F.concat(whole, inside)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        return _rejected_fields(name, value, have, want)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return _rejected_elements(name, value, have, want)
    if isinstance(want, T.StringType):
        return None
    return rejected_value(name, value, _aligned(value, have, want, False, nested), want)


def _rejected_fields(name: Column, value: Column, have: T.StructType, want: T.StructType) -> Column | None:
    found = _matches(have.names, want)
    return all_of(
        rejected(F.concat(name, F.lit(f".{f.name}")), value.getField(found[f.name]), have[found[f.name]].dataType, f.dataType, True)
        for f in want.fields
        if f.name in found
    )


def _rejected_elements(name: Column, value: Column, have: T.ArrayType, want: T.ArrayType) -> Column | None:
    if isinstance(want.elementType, T.StructType) and not isinstance(have.elementType, T.StringType):
        inside, body = map_element(have.elementType)
        if body is not None:
            wanted, fits = want.elementType, _all_fit(value, have, want.elementType)
            return rejected_elements(name, value, lambda at, x: _rejected_fields(at, inside(x), body, wanted), fits)
    fits = None
    if not isinstance(have.elementType, _NESTED) and not isinstance(want.elementType, (*_NESTED, T.TimestampType)):
        fits = _as_many(value, _cast_array(value, have.elementType, want.elementType, False))
    return rejected_elements(name, value, lambda at, x: rejected(at, x, have.elementType, want.elementType, True), fits)


def _as_many(raw: Column, cast: Column) -> Column:
    return F.size(F.array_compact(raw)) == F.size(F.array_compact(cast))


def _all_fit(value: Column, have: T.ArrayType, want: T.StructType) -> Column | None:
    """Whether all fields of all elements fit, by whole arrays; None where that cannot be told."""
    fields = element_fields(have)
    found = _matches(list(fields or ()), want)
    pairs = [(fields[found[f.name]], f.dataType) for f in want.fields if f.name in found]
    if not pairs or any(not field.scalar or isinstance(kind, (*_NESTED, T.TimestampType)) for field, kind in pairs):
        return None
    checks = [
        _as_many(field.take(value), _cast_array(field.take(value), field.kind, kind, False))
        for field, kind in pairs
        if not same_type(field.kind, kind)
    ]
    return reduce(Column.__and__, checks, F.lit(True))
