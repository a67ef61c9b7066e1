"""Lists of values that do not fit their declared type, and the rows they are split off to."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import quoted

REJECT_LIST = "array<struct<name:string,raw:string,wanted:string>>"


def _nothing() -> Column:
    return F.array().cast(REJECT_LIST)


def rejected_value(name: Column, raw: Column, fitting: Column, want: T.DataType) -> Column:
    """A list of one if ``raw`` is there and nothing of it fits."""
    text = raw.cast("string")
    one = F.struct(name.alias("name"), text.alias("raw"), F.lit(want.simpleString()).alias("wanted"))
    return F.when(raw.isNotNull() & fitting.isNull(), F.array(one)).otherwise(_nothing())


def all_of(lists: Iterable[Column | None]) -> Column | None:
    """The lists put together; None if there is none."""
    found = [each for each in lists if each is not None]
    return F.concat(*found) if found else None


def rejected_elements(
    name: Column, value: Column, of_element: Callable[[Column, Column], Column | None], fits: Column | None
) -> Column | None:
    """The lists of an array's elements. Where ``fits`` says that all fit, which compiled code
    can tell for most arrays, the lambda is not run."""
    if of_element(name, F.get(value, F.lit(0))) is None:
        return None
    each = F.transform(value, lambda x, i: of_element(F.concat(name, F.lit("["), i.cast("string"), F.lit("]")), x))
    found = F.coalesce(F.flatten(each), _nothing())
    return found if fits is None else F.when(value.isNull() | fits, _nothing()).otherwise(found)


def split_rejects(df: DataFrame, column: str, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``df`` without the list, and a row for each rejected value: the ``keys`` of its row, name, raw, wanted.

    The outer explode keeps the optimiser from asking first which lists are empty: that
    filter, moved below the aligning projection, made every list twice.
    """
    each = df.select(*map(quoted, keys), F.explode_outer(quoted(column)).alias("__tagloom_reject"))
    return df.drop(column), each.where("__tagloom_reject IS NOT NULL").select(*map(quoted, keys), "__tagloom_reject.*")
