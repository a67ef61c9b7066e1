import pytest
from pyspark.sql import functions as F

from tagloom.functions import (
    any_time_column,
    default_time_column,
    epoch_millis,
    epoch_seconds,
    millis_time_column,
    parse_any,
    to_time_column,
)


def value(spark, text, convert):
    return spark.createDataFrame([(text,)], "t string").select(convert(F.col("t")).cast("string")).first()[0]


@pytest.mark.parametrize(
    "text, time",
    [
        ("1760544780006", "2025-10-15 16:13:00.006"),
        ("001760544780006", "2025-10-15 16:13:00.006"),
        ("1760544780006429", "2025-10-15 16:13:00.006429"),
        ("1760544780", "2025-10-15 16:13:00"),
        ("2025-10-16T14:43:07.123Z", "2025-10-16 14:43:07.123"),
        ("2025-10-16T14:43:07Z", "2025-10-16 14:43:07"),
        ("2025-10-16T14:43:07.123-05:00[UTC-05:00]", "2025-10-16 19:43:07.123"),
        ("2025-10-16T14:43:07.123[UTC-05:00]", "2025-10-16 19:43:07.123"),
        ("2025-10-16T14:43:07[UTC+02:00]", "2025-10-16 12:43:07"),
        ("2025-10-16 14:43:07", "2025-10-16 14:43:07"),
        ("2025-10-16", "2025-10-16 00:00:00"),
        ("2025-10-16T14:43:07+02:00", "2025-10-16 12:43:07"),
        ("12345678901", None),
        ("99999999999999999999999", None),
        ("not a time", None),
        ("[UTC-05:00]", None),
        ("junk]", None),
        ("", None),
        (None, None),
    ],
)
def test_any_notation(spark, text, time):
    assert value(spark, text, parse_any) == time


def test_epochs_out_of_range_are_null_not_errors(spark):
    assert value(spark, "9223372036854775807", epoch_millis) is None
    assert value(spark, "9223372036854775807", epoch_seconds) is None
    assert value(spark, "-1500", epoch_millis) == "1969-12-31 23:59:58.5"


@pytest.mark.parametrize("convert", [default_time_column, millis_time_column, any_time_column])
def test_absent_column_is_added_as_null(frame, convert):
    df = convert(frame([("x",)], "a string"), "seen")
    assert dict(df.dtypes)["seen"] == "timestamp"
    assert df.first()["seen"] is None


def test_type_decides(frame):
    df = frame([(1700000000123, "1700000000", 5, None)], "n bigint, s string, i int, t timestamp")
    for name in ("n", "s", "i", "t", "absent", None):
        df = to_time_column(df, name)
    assert dict(df.dtypes) == {"n": "timestamp", "s": "timestamp", "i": "int", "t": "timestamp"}
    assert df.select(F.col("n").cast("string"), F.col("s").cast("string")).first() == (
        "2023-11-14 22:13:20.123",
        "2023-11-14 22:13:20",
    )
