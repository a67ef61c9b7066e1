import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators import (
    add_metadata,
    is_empty,
    keep_keyed,
    latest_per_key,
    post_filters,
    rename_columns,
    row_count,
    select_columns,
    sorted_projection,
    sql_columns,
    surrogate_id,
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_keyed_keeps_nan_and_drops_null(frame):
    df = frame([(1, float("nan")), (None, 1.0), (2, None), (3, 2.0)], "k int, v double")
    assert sorted(r["k"] for r in keep_keyed(df, ["k", "v"]).collect()) == [1, 3]
    assert keep_keyed(df, []) is df


def test_latest_needs_keys_and_order(frame):
    df = frame([(1, 1), (1, 2)], "k int, v int")
    assert latest_per_key(df, [], "v") is df
    assert latest_per_key(df, ["k"], None) is df


def test_latest_compares_in_the_declared_type(frame):
    df = frame([("a", "999"), ("a", "1760"), ("b", "x"), ("b", "1")], "k string, v string")
    as_text = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "v").collect()}
    as_number = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "v", order_type=T.LongType()).collect()}
    assert as_text == {"a": "999", "b": "x"}
    assert as_number == {"a": "1760", "b": "1"}


def test_latest_ties_and_nulls(frame):
    df = frame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b"), (1, None, "z"), (2, None, "n")], "k int, v int, w string")
    assert {(r["k"], r["w"]) for r in latest_per_key(df, ["k"], "v").collect()} == {(1, "c"), (2, "n")}
    assert {(r["k"], r["w"]) for r in latest_per_key(df, ["k"], "v", tiebreak=["w"]).collect()} == {(1, "c"), (2, "n")}


def test_latest_is_cut_down_before_the_shuffle(frame):
    text = plan(latest_per_key(frame([(1, 1, 1)], "k int, v int, w int"), ["k"], "v"))
    assert "Partial" in text and text.count("Exchange") == 1


def test_latest_with_a_key_that_holds_most_rows(spark):
    df = spark.range(100_000).select(F.when(F.col("id") > 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = latest_per_key(df, ["k"], "v")
    assert latest.count() == 1001
    assert latest.where("k = 0").first()["v"] == 99_999


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5)), st.text("abc", max_size=2)),
        min_size=1,
        max_size=30,
    )
)
def test_latest_equals_brute_force(spark, data):
    best = {}
    for k, v, w in data:
        rank = (v is not None, v if v is not None else 0, w)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, v, w))
    df = spark.createDataFrame(data, "k int, v int, w string").repartition(3)
    assert {tuple(r) for r in latest_per_key(df, ["k"], "v").collect()} == {row for _, row in best.values()}


def test_surrogate_id_only_for_several_keys(frame):
    df = frame([("a", 1, None)], "x string, y int, z string")
    assert surrogate_id(df, ["x", "y"]).first()["id"] == "a-1"
    assert surrogate_id(df, ["x", "z", "y"]).first()["id"] == "a-1"
    assert surrogate_id(df, ["x"]) is df


def test_user_steps_in_order(frame):
    df = frame([(1, 2), (3, 4), (5, 6)], "a int, b int")
    assert post_filters(df, ["a > 1", "b < 6 OR a = 1"]).collect() == [(3, 4)]
    assert rename_columns(df, [("a", "c"), ("nope", "x"), ("c", "d")]).columns == ["d", "b"]
    assert rename_columns(df, {"a": "z"}).columns == ["z", "b"]
    assert sql_columns(df, [("s", "a + b"), ("a", "s * 10"), ("t", "a")]).first() == (30, 2, 3, 30)
    assert select_columns(df, ["b"]).columns == ["b"] and select_columns(df, []) is df
    assert sorted_projection(df.select("b", "a")).columns == ["a", "b"]


def test_names_with_dots(frame):
    df = frame([(1, "k")], "a int, b string").toDF("a.b", "k`ey")
    assert sorted_projection(df).columns == ["a.b", "k`ey"]
    assert latest_per_key(df, ["k`ey"], "a.b").collect() == [(1, "k")]
    assert keep_keyed(surrogate_id(df, ["a.b", "k`ey"]), ["k`ey"]).first()["id"] == "1-k"


def test_counts(frame):
    df = frame([(1,), (2,)], "a int")
    assert row_count(df).collect() == [(2,)]
    assert not is_empty(df) and is_empty(df.where("a > 5"))


INGESTED = dt.datetime(2025, 4, 16, 3, 0, 0)


def test_metadata(frame):
    df = frame([("2025-10-06 14:43:07",)], "created_at string").select(F.to_timestamp("created_at").alias("created_at"))
    row = add_metadata(df, dt.date(2025, 4, 16), ingested_at=INGESTED).first()
    assert (row["year"], row["month"], row["day"]) == (2025, "10", "06")
    added = add_metadata(df, dt.date(2025, 4, 16), ingested_at=INGESTED)
    texts = added.select(F.col("momento_ingestion").cast("string"), F.col("job_process_date").cast("string")).first()
    assert tuple(texts) == ("2025-04-15 22:00:00", "2025-04-16 00:00:00")
    assert dict(added.dtypes)["momento_ingestion"] == "timestamp" and dict(added.dtypes)["month"] == "string"


def test_metadata_without_the_partition_column(frame):
    row = add_metadata(frame([(1,)], "a int"), dt.date(2025, 4, 6), "seen_at").first()
    assert (row["year"], row["month"], row["day"]) == (2025, "04", "06")


def test_ingestion_instant_with_a_zone(frame):
    moment = dt.datetime(2025, 4, 16, 5, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    df = add_metadata(frame([(1,)], "a int"), dt.date(2025, 4, 6), ingested_at=moment)
    assert df.select(F.col("momento_ingestion").cast("string")).first()[0] == "2025-04-15 22:00:00"


def test_ingestion_instant_is_now_by_default(frame):
    df = add_metadata(frame([(1,)], "a int"), dt.date(2025, 4, 6))
    lag = df.select(F.unix_seconds(F.current_timestamp()) - F.unix_seconds("momento_ingestion")).first()[0]
    assert lag == pytest.approx(5 * 3600, abs=5)


def test_null_date_has_a_partition_of_its_own(frame):
    df = frame([(None,)], "created_at timestamp")
    row = add_metadata(df, dt.date(2025, 4, 6)).first()
    assert (row["year"], row["month"], row["day"]) == (None, "null", "null")


def test_unconverted_date_text(frame):
    df = add_metadata(frame([("2025-10-06T01:02:03Z",), ("soon",)], "created_at string"), dt.date(2025, 4, 6))
    assert [tuple(r) for r in df.select("year", "month", "day").collect()] == [(2025, "10", "06"), (None, "null", "null")]
