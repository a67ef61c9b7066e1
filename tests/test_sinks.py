import glob
import os

import pytest
from pyspark.sql import functions as F

from tagloom.schema import schema_from_spec
from tagloom.sinks import write_files, write_partitioned, write_table
from tagloom.sources import read_partitioned


def test_table_is_replaced_and_read_back(spark, folder):
    table = "tagloom_test.overwritten"
    first = write_table(spark.range(10), table, folder + "/t", files=2)
    assert first.count() == 10
    assert len(glob.glob(folder + "/t/*.parquet")) == 2
    again = write_table(spark.range(4).withColumn("x", F.lit("y")), table, folder + "/t")
    assert again.count() == 4 and again.columns == ["id", "x"]
    assert "FileScan parquet" in again._jdf.queryExecution().executedPlan().toString()
    assert spark.table(table).count() == 4


def test_files_with_format_mode_and_options(spark, folder):
    df = spark.createDataFrame([("a|b", None)], "x string, y string")
    for _ in range(2):
        write_files(df, folder + "/c", data_format="csv", mode="append", files=1, options={"sep": "|", "header": "true", "nullValue": "-"})
    assert len(glob.glob(folder + "/c/*.csv")) == 2
    with open(glob.glob(folder + "/c/*.csv")[0], encoding="utf-8") as file:
        assert file.read() == 'x|y\n"a|b"|-\n'


def test_failed_write_names_the_target(spark, folder):
    with pytest.raises(RuntimeError, match="/c failed"):
        write_files(spark.range(1), folder + "/c", data_format="no-such-format")


def test_partitions_have_few_files_and_others_stay(spark, folder):
    days = schema_from_spec([{"Name": "day", "Type": "varchar"}])
    df = spark.range(0, 1000, 1, 16).select("id", F.format_string("%02d", F.col("id") % 5).alias("day"))
    write_partitioned(df, folder + "/p", ["day"])
    folders = sorted(os.path.basename(p) for p in glob.glob(folder + "/p/day=*"))
    assert folders == ["day=00", "day=01", "day=02", "day=03", "day=04"]
    assert all(len(glob.glob(f"{folder}/p/{name}/*.parquet")) == 1 for name in folders)
    write_partitioned(df.where("day = '03'").limit(7), folder + "/p", ["day"])
    counts = read_partitioned(spark, folder + "/p", days).groupBy("day").count()
    assert {r["day"]: r["count"] for r in counts.collect()} == {"00": 200, "01": 200, "02": 200, "03": 7, "04": 200}
