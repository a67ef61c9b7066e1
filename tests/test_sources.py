import datetime as dt
import json
import os
from collections import Counter

import pytest

from tagloom.context import RunContext, fill
from tagloom.sources import (
    dated_path,
    load_source,
    load_sources,
    read_catalog,
    read_format,
    read_partitioned,
    read_tagged,
    table_exists,
)
from tagloom.operators import flatten_tagged
from tagloom.schema import schema_from_spec
from tagloom.scratch import scratch_path, scratch_root, staged
from tagloom.sources.ledger import take_new_files
from tagloom.sources.variant import inferred_type, read_tagged_variant

FULL = RunContext.of("2025-04-06")
INC = RunContext.of("2025-04-06", "INC")


def test_context():
    assert (FULL.root, FULL.incremental, INC.root, INC.incremental) == ("Item", False, "NewImage", True)
    with pytest.raises(ValueError, match="DELTA"):
        RunContext.of("2025-04-06", "DELTA")
    with pytest.raises(ValueError):
        RunContext.of("06/04/2025")


def test_dated_paths():
    template = "s3://{bucket}/{current_process_type_folder}/y={process_year}/m={process_month}/d={process_day}/{process_hour}{current_data_folder}"
    assert dated_path(template, RunContext.of("2025-04-06", bucket="raw")) == "s3://raw/full/y=2025/m=04/d=06/*/data"
    assert dated_path(template, RunContext.of("2025-04-06", "INC", bucket="raw")) == "s3://raw/incremental/y=2025/m=04/d=06/hour=*/data"


def test_fill_reaches_every_text_and_leaves_the_rest():
    tree = {"a": ["{x}", 1, {"b": "{x}{y}"}], "c": None}
    assert fill(tree, {"x": "1"}) == {"a": ["1", 1, {"b": "1{y}"}], "c": None}


def files(template, **details):
    return {"connection_type": "s3_path", "s3_details": {"path_template_full": template, "path_template_inc": template + "/inc", **details}}


@pytest.mark.parametrize(
    "source, message",
    [
        ({"connection_type": "jdbc"}, "unknown kind"),
        ({}, "unknown kind"),
        ({"connection_type": "s3_path"}, "needs s3_details"),
        ({"connection_type": "s3_path", "s3_details": {"path_template_inc": "/x"}}, "path_template_full"),
        (files("relative/path"), "absolute path or a URI"),
        ({"connection_type": "catalog"}, "catalog_details"),
        ({"connection_type": "catalog", "catalog_details": {"database_template": "d"}}, "table_name"),
        ({"origin": "s3", "bucket": "b"}, "prefix"),
    ],
)
def test_bad_sources_fail_before_any_job(spark, source, message):
    with pytest.raises(ValueError, match=message):
        load_source(spark, source, FULL)


def test_mode_chooses_the_path(spark, folder):
    spark.createDataFrame([("full",)], "a string").write.json(folder + "/day=06")
    spark.createDataFrame([("inc",)], "a string").write.json(folder + "/day=06/inc")
    source = files(folder + "/day={process_day}")
    assert load_source(spark, source, FULL).first()["a"] == "full"
    assert load_source(spark, source, INC).first()["a"] == "inc"


def test_other_formats_with_options(spark, folder):
    spark.createDataFrame([(1, "x;y")], "a int, b string").write.option("sep", "|").option("header", True).csv(folder + "/c")
    source = files(folder + "/c", data_format="csv", format_options={"sep": "|", "header": "true", "inferSchema": "true"})
    df = load_source(spark, source, FULL)
    assert df.collect() == [(1, "x;y")] and df.dtypes == [("a", "int"), ("b", "string")]
    assert read_format(spark, "csv", [folder + "/c"], {"sep": "|", "header": "true"}).first()["a"] == "1"


def test_declared_read_needs_no_job(spark, folder):
    spark.createDataFrame([(("1",),)], "Item struct<k: string>").write.json(folder + "/x")
    schema = schema_from_spec([{"Name": "k", "Type": "bigint"}])
    with pytest.raises(ValueError, match="root"):
        read_tagged(spark, folder + "/x", schema=schema)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = read_tagged(spark, folder + "/x", "Item", schema)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert df.schema.simpleString() == "struct<Item:struct<k:struct<N:string,S:string>>>"


def test_only_the_days_files_are_listed(spark, folder):
    for day in ("05", "06"):
        for hour in ("00", "23"):
            spark.createDataFrame([((day + hour,),)], "NewImage struct<k: string>").write.json(f"{folder}/day={day}/hour={hour}/data")
    source = {"connection_type": "s3_path", "s3_details": {"path_template_inc": folder + "/day={process_day}/{process_hour}data"}}
    df = load_source(spark, source, INC)
    assert df.columns == ["NewImage"]
    assert sorted(r[0][0] for r in df.collect()) == ["0600", "0623"]
    assert all("/day=06/" in name for name in df.inputFiles())


def test_catalog_source_with_predicates(spark, folder):
    spark.range(20).selectExpr("id", "id % 4 AS part").write.partitionBy("part").option("path", folder + "/t").mode("overwrite").saveAsTable("src_predicates")
    assert table_exists(spark, "default", "src_predicates") and not table_exists(spark, None, "src_nothing")
    source = {
        "connection_type": "catalog",
        "catalog_details": {
            "database_template": "{db}",
            "table_name": "src_predicates",
            "additional_options_templates": {"catalogPartitionPredicate": "part = {part} OR part = 3"},
            "push_down_predicate_template": "id > 4",
        },
    }
    context = RunContext.of("2025-04-06", db="default", part="1")
    df = load_source(spark, source, context)
    assert sorted(r["id"] for r in df.collect()) == [5, 7, 9, 11, 13, 15, 17, 19]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "part" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert read_catalog(spark, None, "src_predicates").count() == 20


def test_named_sources_and_hooks(spark, folder):
    spark.range(5).write.json(folder + "/a")
    spark.range(3).write.mode("overwrite").option("path", folder + "/b").saveAsTable("src_named")
    sources = load_sources(
        spark,
        {"files": files(folder + "/a"), "table": {"origin": "catalog", "database": "default", "table_name": "src_named"}},
        FULL,
        {"table": lambda df: df.where("id > 0")},
    )
    assert {name: df.count() for name, df in sources.items()} == {"files": 5, "table": 2}


def test_partition_types_are_kept(spark, folder):
    fields = schema_from_spec([{"Name": "month", "Type": "varchar"}])
    spark.createDataFrame([(1, "01"), (2, "11")], "a int, month string").write.partitionBy("month").parquet(folder + "/p")
    spark.createDataFrame([(3, "x", "12")], "a int, b string, month string").write.mode("append").partitionBy("month").parquet(folder + "/p")
    df = read_partitioned(spark, folder + "/p", fields, merge_schema=True)
    assert dict(df.dtypes) == {"a": "int", "b": "string", "month": "string"}
    assert sorted(tuple(r) for r in df.select("a", "month").collect()) == [(1, "01"), (2, "11"), (3, "12")]


def test_scratch_paths_are_shared_and_new(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = staged(spark.range(3).selectExpr("id", "named_struct('a', id) AS s"))
    assert df.count() == 3 and "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("start", ["", "file:", "file://"])
def test_paths_are_absolute_or_uris(spark, folder, start):
    """``file:/x`` is how Hadoop writes a local path, those of the checkpoint folder among them."""
    spark.createDataFrame([((("a",),),)], "Item struct<k: struct<S: string>>").write.json(f"{folder}/export")
    read = load_source(spark, files(f"{start}{folder}/export"), RunContext.of("2024-01-15"))
    assert [r.Item.k.S for r in read.collect()] == ["a"]
    with pytest.raises(ValueError, match="absolute path or a URI"):
        load_source(spark, files(f"file:{folder[1:]}/export"), RunContext.of("2024-01-15"))


def test_a_cluster_has_to_name_its_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    Session.conf = {"spark.checkpoint.dir": "s3a://shared/"}
    assert scratch_root(Session()) == "s3a://shared"


def test_a_file_folder_is_tried_on_a_cluster(spark, folder, monkeypatch):
    """A ``file:`` folder can be a mount that all machines share; one that is not is found out."""

    class Session:
        def __init__(self, name, **other):
            self.conf = {"spark.checkpoint.dir": f"{folder}/{name}/"}
            self.__dict__.update(other)

        def __getattr__(self, name):
            return getattr(spark, name)

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    for scheme in ("", "file:", "file://"):
        shared = Session("shared")
        shared.conf = {"spark.checkpoint.dir": f"{scheme}{folder}/shared/"}
        assert scratch_root(shared) == f"{scheme}{folder}/shared"
    assert os.listdir(f"{folder}/shared/tagloom") == []
    # the executors' rows stay on their machines
    apart = Session("apart", range=lambda *_: spark.range(0))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is local to a machine"):
        scratch_root(apart)
    # tried once
    assert scratch_root(Session("shared", range=None)) == f"{folder}/shared"


@pytest.mark.parametrize("named", [True, False])
def test_a_cluster_without_a_shared_folder_uses_its_warehouse(spark, folder, monkeypatch, named):
    """The warehouse is shared by all machines; a folder named beside it may not be."""
    local = f"{folder}/apart"

    def written(*counts):
        # rows that go to the folder that is tried first stay on the executors' machines
        return spark.range(0) if named and not os.path.exists(local) else spark.range(*counts)

    class Session:
        range = staticmethod(written)

        def __init__(self, warehouse):
            self.conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": local} if named else {})

        def __getattr__(self, name):
            return getattr(spark, name)

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    assert scratch_root(Session(f"file:{folder}/shared/")) == f"file:{folder}/shared/tagloom-scratch"
    assert scratch_root(Session("s3a://shared/warehouse")) == "s3a://shared/warehouse/tagloom-scratch"
    # nor the warehouse
    monkeypatch.setattr(Session, "range", staticmethod(lambda *_: spark.range(0)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is local" if named else "set spark.checkpoint.dir"):
        scratch_root(Session(f"{folder}/neither"))


def test_declared_schema_of_other_formats(spark, folder):
    """CSV is read with the declared types; files that hold tagged records keep their own."""
    schema = schema_from_spec([{"Name": "a", "Type": "bigint"}, {"Name": "b", "Type": "varchar"}])
    spark.createDataFrame([(1, "07")], schema).write.csv(folder + "/csv")
    spark.createDataFrame([(1, "07", 2.5)], "a int, b string, c double").write.orc(folder + "/orc")
    spark.createDataFrame([((("x",),),)], "Item struct<a:struct<S:string>>").write.parquet(folder + "/tagged")

    def load(name, data_format):
        details = {"path_template_full": f"{folder}/{name}", "data_format": data_format}
        return load_source(spark, {"connection_type": "s3_path", "s3_details": details}, RunContext.of("2025-01-01"), schema)

    assert load("csv", "csv").schema.simpleString() == "struct<a:bigint,b:string>" and load("csv", "csv").first() == (1, "07")
    assert load("orc", "orc").columns == ["a", "b"] and load("orc", "orc").first() == (1, "07")
    assert load("tagged", "parquet").columns == ["Item"]


# --- one read without a declared schema ------------------------------------------------------

MIXED = [
    {"Item": {"a": {"S": "x"}, "n": {"N": "1"}, "l": {"L": [{"S": "q"}, {"M": {"z": {"N": "2"}}}, {"NULL": True}]}, "ss": {"SS": ["b", "a"]}, "e": {"M": {}}, "mix": {"S": "t"}}},
    {"Item": {"a": {"N": "7"}, "b": {"BOOL": True}, "mix": {"L": [{"S": "u"}]}, "nul": {"NULL": True}, "odd": {"S": 5}, "em": {"L": []}, "conf": {"M": {"q": "plain"}}}},
    {"Item": {"conf": {"M": {"q": {"S": "tagged"}}}, "odd": {"S": "x"}, "num": {"N": 1.5}, "big": {"N": 12345678901234567890123}, "int": {"N": 3}}},
    {"Keys": {"a": {"S": "x"}}, "OldImage": {"a": {"S": "unread"}}},
    {"Item": {"with space": {"S": "1"}, "a.b": {"S": "2"}, "tick`s": {"S": "3"}, "OBJECT<": {"S": "4"}, "VOID": {"S": "5"}, "1e5": {"N": "6"}, "é": {"S": "7"}, "struct": {"M": {"x: y": {"S": "8"}}}}},
    {"Item": None, "Metadata": {"WriteTimestampMicros": {"N": "9"}}},
]


def lines(folder, *records, name="part.json"):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.writelines((r if isinstance(r, str) else json.dumps(r, separators=(",", ":"))) + "\n" for r in records)
    return f"{folder}/{name}"


def test_variant_read_equals_the_inferred_one(spark, folder):
    path = lines(folder, *MIXED, "no json", '{"Item": {"a"', "7", '["x"]')
    inferred, variant = spark.read.json(path).select("Item", "Keys", "Metadata"), read_tagged_variant(spark, path, "Item")
    types = {f.name: f.dataType for f in inferred.schema.fields}
    assert {f.name: f.dataType.simpleString() for f in variant.schema.fields} == {n: t.simpleString() for n, t in types.items()}
    blanks = lambda rows: Counter(str(r.asDict(True)).replace('": ', '":') for r in rows)
    assert blanks(variant.select("Item", "Keys", "Metadata").collect()) == blanks(inferred.collect())


def test_variant_read_scans_json_once(spark, folder):
    path = lines(folder, *MIXED)
    records = read_tagged_variant(spark, path, "Item")
    os.remove(path)
    assert records.where("Item IS NOT NULL").count() == 4
    plan = flatten_tagged(records.select("Item"), "Item", on_collision="coalesce")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "FileScan json" not in plan and "Keys" not in plan.split("ReadSchema")[1]
    assert os.path.isdir(records.staged_path.removeprefix("file:"))


def test_variant_read_of_little(spark, folder):
    os.makedirs(folder + "/a")
    records = read_tagged_variant(spark, lines(folder, name="a/empty.json").rsplit("/", 1)[0], "Item")
    assert records.collect() == [] and "Item" not in records.columns
    deletes = read_tagged_variant(spark, lines(folder, {"Keys": {"k": {"S": "x"}}}, {"Keys": {"k": {"N": "1"}}}), "NewImage")
    assert deletes.columns == ["Keys"] and deletes.select("Keys.k.*").columns == ["N", "S"]


@pytest.mark.parametrize(
    "spelled, kind",
    [
        (None, None), ("VOID", None), ("OBJECT<>", None), ("STRING", "string"), ("OBJECT<a: VARIANT, b: VOID>", "struct<a:string,b:string>"),
        ("OBJECT<a: OBJECT<>, b: BIGINT>", "struct<b:bigint>"), ("OBJECT<a: ARRAY<OBJECT<>>>", None), ("OBJECT<a: ARRAY<VOID>>", "struct<a:array<string>>"),
        ("OBJECT<a: DECIMAL(3,1), b: DECIMAL(20,0)>", "struct<a:double,b:decimal(20,0)>"),
    ],
)
def test_types_of_variants(spark, spelled, kind):
    found = inferred_type(spelled)
    assert (found.simpleString() if found is not None else None) == kind


# --- files taken once ------------------------------------------------------------------------


def taken_source(folder, **more):
    details = {"path_template_inc": folder + "/day={process_day}/{process_hour}data", "ledger": folder + "/ledger", **more}
    return {"connection_type": "s3_path", "s3_details": details}


def drop_file(folder, day, name, *values):
    path = f"{folder}/day={day:02}/hour=07/data"
    os.makedirs(path, exist_ok=True)
    lines(path, *[{"NewImage": {"a": {"S": v}}} for v in values], name=name)
    return f"{path}/{name}"


def values_of(df):
    return sorted(r.S for r in df.select("NewImage.a.S").collect())


def test_files_are_taken_once(spark, folder):
    context = RunContext.of("2025-04-16", "INC")
    load = lambda day=context, **more: load_source(spark, taken_source(folder, **more), day)
    first = drop_file(folder, 16, "part-{1}[x].json", "one")
    drop_file(folder, 16, "b c.json", "two")
    df = load()
    assert values_of(df) == ["one", "two"]
    drop_file(folder, 16, "late.json", "three")  # after the listing: the next run's
    assert values_of(df) == ["one", "two"]
    df.taken.remember()
    drop_file(folder, 15, "earlier.json", "four")
    df = load()
    assert values_of(df) == ["three"] and not os.path.exists(folder + "/never")
    df.taken.release()  # not remembered: taken again
    df = load(days_back=2)
    assert values_of(df) == ["four", "three"]
    df.taken.remember()
    os.utime(first, (1, 1))
    df = load(days_back=2)
    assert values_of(df) == ["one"]
    df.taken.remember()
    df = load(days_back=2)
    assert df.columns == [] and df.taken.paths == []
    ledger = spark.read.parquet(folder + "/ledger")
    assert ledger.count() == 5 and ledger.select("path").distinct().count() == 4
    assert len(load(RunContext.of("2025-04-17", "INC"), days_back=1, ledger=folder + "/other").taken.paths) == 3


def test_declared_read_of_no_new_files(spark, folder):
    schema = schema_from_spec([{"Name": "a", "Type": "varchar"}])
    df = load_source(spark, taken_source(folder), RunContext.of("2025-04-16", "INC"), schema)
    assert df.columns == ["NewImage"] and df.collect() == []
    df.taken.remember()
    assert spark.read.parquet(folder + "/ledger").count() == 0


def test_listing_opens_no_file(spark, folder):
    drop_file(folder, 16, "a.json", "x")
    taken = take_new_files(spark, [folder + "/day=16/*/data", folder + "/none/*"], folder + "/ledger", dt.date(2025, 4, 16))
    assert [p.rsplit("/", 1)[1] for p in taken.paths] == ["a.json"]
    found = spark.read.format("binaryFile").load(folder + "/day=16/*/data").select("path", "modificationTime")
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in found._jdf.queryExecution().executedPlan().toString()
