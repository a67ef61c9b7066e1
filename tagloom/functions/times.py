"""Time columns: texts and epoch numbers to TIMESTAMP.

Nothing here can fail on a bad value: what does not parse becomes NULL, because
under ANSI mode one bad row would otherwise end the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import quoted

# Patterns of the notations that differ from ISO.
_DIGITS = r"^\d{10,}$"
_OFFSET_AND_BRACKET = r"([-+]\d{2}:\d{2})\[UTC[-+]\d{2}:\d{2}\]$"
_BRACKET_ONLY = r"\[UTC([-+]\d{2}:\d{2})\]$"

# Largest epoch values whose microseconds still fit a 64-bit integer.
_MAX_MILLIS = 9_223_372_036_854_775
_MAX_SECONDS = 9_223_372_036_854


def _within(number: Column, limit: int) -> Column:
    return F.when(number.between(-limit, limit), number)


def epoch_seconds(value: Column) -> Column:
    """Epoch seconds (number or digits) to TIMESTAMP."""
    return F.timestamp_seconds(_within(value.try_cast("bigint"), _MAX_SECONDS))


def epoch_millis(value: Column) -> Column:
    """Epoch milliseconds (number or digits) to TIMESTAMP, milliseconds kept."""
    return F.timestamp_millis(_within(value.try_cast("bigint"), _MAX_MILLIS))


def parse_default(text: Column) -> Column:
    """ISO-like text to TIMESTAMP; an offset or ``Z`` in the text is honoured."""
    return F.try_to_timestamp(text)


def parse_any(text: Column) -> Column:
    """Text in any of the known notations to TIMESTAMP.

    Digits are epoch values: 10 of them seconds, 13-15 milliseconds, 16-18 microseconds,
    19 nanoseconds (cut to microseconds). ``...[UTC-05:00]`` takes the bracketed offset unless the text
    has one of its own. Everything else goes through :func:`parse_default`.
    """
    digits = F.length(text)
    number = text.try_cast("bigint")
    unbracketed = F.regexp_replace(F.regexp_replace(text, _OFFSET_AND_BRACKET, "$1"), _BRACKET_ONLY, "$1")
    # one regex separates digits from texts; the bracket rewrite runs only where a bracket is
    return (
        F.when(
            text.rlike(_DIGITS),
            F.when(digits == 10, epoch_seconds(number))
            .when(digits >= 19, F.timestamp_micros(F.call_function("div", number, F.lit(1000))))
            .when(digits >= 16, F.timestamp_micros(number))
            .when(digits >= 13, epoch_millis(number)),
        )
        .when(text.endswith("]"), parse_default(unbracketed))
        .otherwise(parse_default(text))
    )


def _replaced(df: DataFrame, name: str, convert) -> DataFrame:
    source = F.col(quoted(name)) if name in df.columns else F.lit(None).cast("string")
    return df.withColumn(name, convert(source))


def default_time_column(df: DataFrame, name: str) -> DataFrame:
    """Replace text column ``name`` by its default parse; NULL if it is absent."""
    return _replaced(df, name, parse_default)


def millis_time_column(df: DataFrame, name: str) -> DataFrame:
    """Replace epoch-millisecond column ``name`` by its TIMESTAMP; NULL if absent."""
    return _replaced(df, name, epoch_millis)


def any_time_column(df: DataFrame, name: str) -> DataFrame:
    """Replace text column ``name`` in any known notation; NULL if absent."""
    return _replaced(df, name, parse_any)


def to_time_column(df: DataFrame, name: str | None) -> DataFrame:
    """Convert ``name`` as its type asks: BIGINT is epoch milliseconds, STRING any
    known notation, other types and absent columns stay as they are (T4)."""
    if not name or name not in df.columns:
        return df
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):
        return millis_time_column(df, name)
    if isinstance(kind, T.StringType):
        return any_time_column(df, name)
    return df
