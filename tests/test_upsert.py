import glob
import os
import shutil
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.schema import schema_from_spec
from tagloom.scratch import scratch_path, scratch_root
from tagloom.sinks import apply_changes, merge, read_upserted, upsert
from tagloom.sinks.merge import UnfinishedCommit
from tagloom.sources import read_partitioned

PARTS = schema_from_spec([{"Name": "year", "Type": "integer"}, {"Name": "day", "Type": "varchar"}])
DDL = "id string, v bigint, w string, year int, day string"


def put(spark, path, rows, ddl=DDL, **more):
    upsert(spark.createDataFrame(rows, ddl), path, ["id"], "v", ["year", "day"], **more)


def stored(spark, path, *columns):
    df = read_partitioned(spark, path, PARTS, merge_schema=True)
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def modified(path):
    return {f: f for f in glob.glob(path + "/year=*/day=*/*.parquet")}.keys()


def test_newest_wins_incoming_wins_ties_older_loses(spark, folder):
    path = folder + "/t"
    put(spark, path, [("new", 1, "a", 2024, "01"), ("tie", 5, "a", 2024, "01"), ("old", 9, "a", 2024, "01"), ("gone", 1, "a", 2024, "01")])
    put(spark, path, [("new", 2, "b", 2024, "01"), ("tie", 5, "0", 2024, "01"), ("old", 8, "b", 2024, "01"), ("more", 1, "b", 2024, "01")])
    assert stored(spark, path, "id", "w") == [("gone", "a"), ("more", "b"), ("new", "b"), ("old", "a"), ("tie", "0")]


def test_batch_is_reduced_first(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01"), ("a", 3, "y", 2024, "01"), ("a", None, "z", 2024, "01")])
    assert stored(spark, folder + "/t", "id", "v", "w") == [("a", 3, "y")]


def test_key_that_moves_stays_in_both_partitions(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01")])
    put(spark, folder + "/t", [("a", 2, "y", 2024, "02")])
    assert stored(spark, folder + "/t", "id", "day") == [("a", "01"), ("a", "02")]


def test_untouched_partitions_keep_their_files(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 1, "x", 2024, "01"), ("b", 1, "x", 2024, "02"), ("c", 1, "x", 2023, "01")])
    before = modified(path)
    put(spark, path, [("a", 2, "y", 2024, "01"), ("d", 1, "y", 2025, "09")])
    kept = before & modified(path)
    assert sorted(name.split("/t/")[1].rsplit("/", 1)[0] for name in kept) == ["year=2023/day=01", "year=2024/day=02"]
    assert len(stored(spark, path)) == 4


@pytest.mark.parametrize("more", [{}, {"partitions_at_once": 1}, {"rows_per_file": 2}, {"rows_per_file": 2, "partitions_at_once": 3}])
def test_all_ways_of_finding_and_splitting_partitions_agree(spark, folder, more):
    path = folder + "/t"
    first = [(f"k{i}", i % 3, "a", 2024 if i % 2 else None, ["01", None, "a b/c:d", "x=y"][i % 4]) for i in range(40)]
    second = [(f"k{i}", 1, "b", 2024 if i % 2 else None, ["01", None, "a b/c:d", "x=y"][i % 4]) for i in range(20, 60)]
    put(spark, path, first, **more)
    put(spark, path, second, **more)
    best = {(r[0], r[3], r[4]): r for r in first}
    for r in second:
        if (r[0], r[3], r[4]) not in best or best[r[0], r[3], r[4]][1] <= r[1]:
            best[r[0], r[3], r[4]] = r
    assert stored(spark, path) == sorted(best.values(), key=str)


def test_large_partition_is_split_small_ones_are_not(spark, folder):
    path = folder + "/t"
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.lit(1).cast("bigint").alias("v"),
        F.lit("w").alias("w"),
        F.lit(2024).alias("year"),
        F.when(F.col("id") < 2900, "01").otherwise("02").alias("day"),
    )
    upsert(df, path, ["id"], "v", ["year", "day"], rows_per_file=500)
    files = {day: len(glob.glob(f"{path}/year=2024/day={day}/*.parquet")) for day in ("01", "02")}
    assert files["02"] == 1 and 3 <= files["01"] <= 6
    assert len(stored(spark, path)) == 3000


def test_new_and_absent_columns(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 1, "x", 2024, "01"), ("b", 1, "x", 2024, "01")])
    put(spark, path, [("b", 2, 7, 2024, "01")], "id string, v bigint, extra int, year int, day string")
    assert stored(spark, path, "id", "w", "extra") == [("a", "x", None), ("b", None, 7)]
    # a batch without the column must not drop it from the partition
    put(spark, path, [("c", 1, "z", 2024, "01")])
    assert stored(spark, path, "id", "w", "extra") == [("a", "x", None), ("b", None, 7), ("c", "z", None)]


def test_new_and_absent_struct_fields(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 1, ("x", 1), 2024, "01")], "id string, v bigint, s struct<p: string, q: int>, year int, day string")
    put(spark, path, [("b", 1, ("y", 2.5), 2024, "01")], "id string, v bigint, s struct<p: string, r: double>, year int, day string")
    assert stored(spark, path, "id", "s.p", "s.q", "s.r") == [("a", "x", 1, None), ("b", "y", None, 2.5)]


def test_other_type_is_refused(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01")])
    with pytest.raises(ValueError, match="w.*string.*int"):
        put(spark, folder + "/t", [("a", 2, 5, 2024, "01")], "id string, v bigint, w int, year int, day string")
    assert stored(spark, folder + "/t", "id", "w") == [("a", "x")]


def test_null_key_ends_the_job(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01")])
    with pytest.raises(Exception, match="record key id is NULL"):
        put(spark, folder + "/t", [(None, 2, "y", 2024, "01")])
    assert stored(spark, folder + "/t", "id", "w") == [("a", "x")]


def test_missing_columns_and_keys(spark, folder):
    df = spark.createDataFrame([("a", 1)], "id string, v bigint")
    with pytest.raises(ValueError, match="year"):
        upsert(df, folder + "/t", ["id"], "v", ["year"])
    with pytest.raises(ValueError, match="key column"):
        upsert(df, folder + "/t", [], "v", ["id"])


def test_empty_batch_changes_nothing(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01")])
    put(spark, folder + "/t", [])
    put(spark, folder + "/new", [])
    assert stored(spark, folder + "/t", "id") == [("a",)]


def test_staged_parquet_is_not_copied(spark, folder, monkeypatch):
    spark.createDataFrame([("a", 1, "x", 2024, "01")], DDL).write.parquet(folder + "/b")
    monkeypatch.setattr("tagloom.sinks.merge.stage", lambda *a: pytest.fail("copied"))
    upsert(spark.read.parquet(folder + "/b"), folder + "/t", ["id"], "v", ["year", "day"], staged=True, unique=True)
    assert stored(spark, folder + "/t", "id") == [("a",)]


ROW = st.tuples(
    st.sampled_from(["a", "b", "c"]), st.integers(0, 4), st.sampled_from(["x", "y"]), st.just(2024), st.sampled_from(["01", "02"])
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.lists(ROW, min_size=1, max_size=8), second=st.lists(ROW, min_size=1, max_size=8))
def test_equals_brute_force_and_twice_is_once(spark, first, second):
    path = scratch_path(spark, "property")
    best = {}
    for batch in (first, second):
        winners = {}
        for r in batch:
            key = (r[0], r[4])
            if key not in winners or (r[1], r[2]) > (winners[key][1], winners[key][2]):
                winners[key] = r
        for key, r in winners.items():
            if key not in best or r[1] >= best[key][1]:
                best[key] = r
        put(spark, path, batch)
    expected = sorted(best.values(), key=str)
    assert stored(spark, path) == expected
    put(spark, path, second)
    assert stored(spark, path) == expected


def test_empty_text_and_null_are_one_partition(spark, folder):
    for at_once in (1, 2000):
        path = f"{folder}/t{at_once}"
        put(spark, path, [("a", 1, "x", 2024, None), ("b", 1, "x", 2024, None)])
        put(spark, path, [("c", 1, "y", 2024, ""), ("b", 2, "y", 2024, "")], partitions_at_once=at_once)
        assert stored(spark, path, "id", "w", "day") == [("a", "x", None), ("b", "y", None), ("c", "y", None)]


def test_other_type_in_an_untouched_partition_is_refused(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 1, 2.5, 2024, "01")], "id string, v bigint, w double, year int, day string")
    with pytest.raises(ValueError, match="w.*double.*string"):
        put(spark, path, [("a", 1, "x", 2024, "02")])
    assert stored(spark, path, "id", "w") == [("a", 2.5)]


def test_other_writers_table_is_taken_over(spark, folder):
    path = folder + "/t"
    spark.createDataFrame([("a", 1, 7, 2024, "01")], "id string, v bigint, x int, year int, day string").write.partitionBy("year", "day").parquet(path)
    spark.createDataFrame([("b", 1, "w", 2024, "02")], DDL).write.mode("append").partitionBy("year", "day").parquet(path)
    put(spark, path, [("a", 2, "new", 2024, "01"), ("c", 1, "new", 2024, "02")])
    assert stored(spark, path, "id", "w", "x") == [("a", "new", None), ("b", "w", None), ("c", "new", None)]
    with pytest.raises(ValueError, match="x.*int.*string"):
        put(spark, path, [("d", 1, "s", 2025, "09")], "id string, v bigint, x string, year int, day string")


def test_commit_that_broke_off_is_resumed(spark, folder, monkeypatch):
    path = folder + "/t"
    put(spark, path, [("a", 1, "x", 2024, "01"), ("b", 1, "x", 2024, "01"), ("c", 1, "x", 2024, "02"), ("z", 1, "x", 2023, "01")])

    def crash(*_):
        # what a crash leaves after Spark deleted a stored partition and before the new one is in place
        shutil.move(f"{path}/year=2024/day=01", folder + "/lost")
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr("tagloom.sinks.merge._swap", crash)
        with pytest.raises(UnfinishedCommit) as broken:
            put(spark, path, [("b", 2, "y", 2024, "01"), ("d", 1, "y", 2024, "02")])
    assert [r[0] for r in stored(spark, path)] == ["c", "z"]
    frame = spark.createDataFrame([], DDL)
    upsert(frame, path, ["id"], "v", ["year", "day"], resume_from=broken.value.resume_from)
    assert stored(spark, path, "id", "w") == [("a", "x"), ("b", "y"), ("c", "x"), ("d", "y"), ("z", "x")]
    assert not os.path.exists(broken.value.resume_from.removeprefix("file:"))


def test_scratch_is_emptied(spark, folder):
    path = folder + "/t"
    before = set(glob.glob(scratch_root(spark).removeprefix("file:") + "/tagloom/upsert*"))
    put(spark, path, [("a", 1, "x", 2024, "01"), ("b", 1, "x", 2024, "02")], partitions_at_once=1)
    put(spark, path, [("a", 2, "x", 2024, "01")])
    assert set(glob.glob(scratch_root(spark).removeprefix("file:") + "/tagloom/upsert*")) == before


def test_null_precombine_is_lowest(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", None, "old", 2024, "01"), ("b", 1, "old", 2024, "01"), ("c", None, "old", 2024, "01")])
    put(spark, path, [("a", None, "new", 2024, "01"), ("b", None, "new", 2024, "01"), ("c", -5, "new", 2024, "01")])
    assert stored(spark, path, "id", "w") == [("a", "new"), ("b", "old"), ("c", "new")]


def test_only_touched_folders_are_read_and_no_window_is_over_stored_rows(spark, folder, monkeypatch):
    path = folder + "/t"
    put(spark, path, [(f"k{i}", 1, "x", 2024, f"{i % 9:02}") for i in range(90)])
    seen = []
    merged = merge._merged
    monkeypatch.setattr(merge, "_merged", lambda stored, *more: (seen.append(stored), merged(stored, *more))[1])
    put(spark, path, [("k1", 2, "y", 2024, "01")])
    (rows,) = seen
    assert {f.split("/day=")[1].split("/")[0] for f in rows.inputFiles()} == {"01"}
    incoming = spark.createDataFrame([("k1", 2, "y", 2024, "01")], DDL)
    plan = merged(rows, incoming, ["id"], "v", ["year", "day"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


# --- deletes -----------------------------------------------------------------------------

CHANGES = "id string, v bigint, w string, t bigint, year int, day string"


def change(spark, path, rows, deletes, ddl=CHANGES, **more):
    gone = spark.createDataFrame(deletes, "id string, t bigint")
    return apply_changes(spark.createDataFrame(rows, ddl), gone, path, ["id"], "v", ["year", "day"], changed="t", **more)


def test_deletes_in_any_partition_by_time(spark, folder):
    path = folder + "/t"
    change(spark, path, [("a", 1, "x", 10, 2024, "01"), ("b", 1, "x", 10, 2024, "01"), ("c", 1, "x", 10, 2024, "02"), ("c", 1, "x", 30, 2024, "03"), ("d", 1, "x", None, 2024, "04")], [])
    done = change(spark, path, [], [("a", 11), ("c", 20), ("b", 10), ("d", 1), ("never", 99), (None, 50)])
    assert (done.rows, done.deleted) == (0, 3)
    assert stored(spark, path, "id", "t", "day") == [("b", 10, "01"), ("c", 30, "03")]


def test_delete_then_new_row_in_one_batch(spark, folder):
    """The stored and the older incoming row no longer compete, though their precombine is greater."""
    path = folder + "/t"
    change(spark, path, [("a", 9, "stored", 10, 2024, "01")], [])
    batch = [("a", 8, "before", 15, 2024, "01"), ("a", 1, "after", 25, 2024, "01")]
    for _ in range(2):
        change(spark, path, batch, [("a", 20), ("a", 12)])
        assert stored(spark, path, "v", "w") == [(1, "after")]
    change(spark, path, [("a", 9, "late", 30, 2024, "01")], [("a", 28)])
    assert stored(spark, path, "v", "w") == [(9, "late")]


def test_partition_without_rows_is_removed(spark, folder):
    for at_once in (1, 2000):
        path = f"{folder}/t{at_once}"
        change(spark, path, [("a", 1, "x", 10, 2024, "01"), ("b", 1, "x", 10, 2024, "02"), ("c", 1, "x", 10, 2024, None)], [])
        done = change(spark, path, [("d", 1, "y", 20, 2024, "02")], [("a", 20), ("b", 20), ("c", 20)], partitions_at_once=at_once)
        assert (done.rows, done.deleted) == (1, 3)
        assert stored(spark, path, "id", "day") == [("d", "02")] and len(glob.glob(path + "/year=*/day=*")) == 1


def test_deletes_without_times_precede_the_batch(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 5, "old", 2024, "01"), ("b", 5, "old", 2024, "02")])
    gone = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    apply_changes(spark.createDataFrame([("a", 1, "new", 2024, "01")], DDL), gone, path, ["id"], "v", ["year", "day"])
    assert stored(spark, path, "id", "v", "w") == [("a", 1, "new")]


def test_deletes_of_a_new_table_and_untouched_files(spark, folder):
    path = folder + "/t"
    assert change(spark, path, [], [("a", 1)]).deleted == 0 and not os.path.exists(path)
    change(spark, path, [(f"k{i}", 1, "x", 10, 2024, f"{i % 4:02}") for i in range(40)], [("k3", 9), ("k4", 11)])
    before = modified(path)
    assert len(stored(spark, path)) == 39
    change(spark, path, [], [("k5", 11)])
    assert {f.split("/day=")[1].split("/")[0] for f in before - modified(path)} == {"01"}


def test_two_keys_one_of_them_frequent(spark, folder):
    """A key that holds a third of the batch, deleted half way."""
    path, ddl = folder + "/t", "k string, n bigint, v bigint, t bigint, year int, day string"
    rows = [("hot", 1, i, i, 2024, "01") for i in range(300)] + [(f"k{i % 5}", i, 1, 5, 2024, "01") for i in range(600)]
    gone = spark.createDataFrame([("hot", 1, 150), ("k1", 1, 9), ("k1", 2, 9)], "k string, n bigint, t bigint")
    done = apply_changes(spark.createDataFrame(rows, ddl), gone, path, ["k", "n"], "v", ["year", "day"], changed="t")
    assert done.rows == 600 and stored(spark, path, "k", "v")[:1] == [("hot", 299)]
    assert ("k1", 1) not in stored(spark, path, "k", "n") and ("k2", 2) in stored(spark, path, "k", "n")


# --- wider types ---------------------------------------------------------------------------

OLD = "id string, v int, w float, p decimal(5,2), q int, s struct<a:int,b:string>, l array<int>, year int, day string"
NEW = "id string, v bigint, w double, p decimal(9,4), q decimal(12,2), s struct<a:bigint,c:string>, l array<bigint>, year int, day string"


def test_wider_types_are_taken_over(spark, folder):
    path = folder + "/t"
    old = [("a", 1, 0.5, Decimal("1.25"), 7, (1, "x"), [1], 2024, "01"), ("b", 1, 0.5, None, 7, None, None, 2024, "02")]
    put(spark, path, old, OLD)
    put(spark, path, [("a", 2**40, 0.1, Decimal("1.0001"), Decimal("5.25"), (2**40, "c"), [2**40], 2024, "01"), ("c", 1, 0.1, None, None, None, None, 2024, "01")], NEW)
    got = {r.id: r for r in read_upserted(spark, path).collect()}
    assert (got["a"].v, got["a"].w, got["a"].p, got["a"].q, got["a"].l) == (2**40, 0.1, Decimal("1.0001"), Decimal("5.25"), [2**40])
    assert got["a"].s.asDict() == {"a": 2**40, "b": None, "c": "c"}
    assert (got["b"].v, got["b"].w, got["b"].q) == (1, 0.5, Decimal("7.00"))
    with pytest.raises(ValueError, match="v.*bigint.*int"):
        put(spark, path, old, OLD)


@pytest.mark.parametrize(
    "stored_type, incoming, wider",
    [
        ("int", "bigint", True), ("bigint", "int", False), ("smallint", "int", True), ("float", "double", True), ("double", "float", False),
        ("int", "double", True), ("bigint", "double", False), ("int", "float", False), ("float", "bigint", False), ("int", "string", False),
        ("decimal(5,2)", "decimal(6,2)", True), ("decimal(5,2)", "decimal(6,3)", True), ("decimal(5,2)", "decimal(6,4)", False), ("decimal(5,2)", "decimal(4,2)", False),
        ("int", "decimal(10,0)", True), ("int", "decimal(10,1)", False), ("bigint", "decimal(20,0)", True), ("decimal(5,2)", "double", False), ("int", "int", False),
    ],
)
def test_lattice_of_types(stored_type, incoming, wider):
    a, b = (T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (stored_type, incoming))
    assert merge.wider_type(a, b) is wider


def test_partition_columns_are_not_widened(spark, folder):
    put(spark, folder + "/t", [("a", 1, "x", 2024, "01")])
    with pytest.raises(ValueError, match="year.*int.*bigint"):
        put(spark, folder + "/t", [("a", 1, "x", 2024, "01")], "id string, v bigint, w string, year bigint, day string")


def test_folders_are_found_by_one_listing_of_their_parents(spark, folder):
    path = folder + "/t"
    put(spark, path, [("a", 1, "x", 2024, "01"), ("b", 1, "x", 2024, "a:b"), ("c", 1, "x", 2023, None)])
    names = ["year=2024/day=01", "year=2024/day=a%3Ab", "year=2024/day=02", "year=2022/day=01", "year=2023/day=__HIVE_DEFAULT_PARTITION__"]
    assert merge._existing(spark, path, names) == [names[0], names[1], names[4]]
