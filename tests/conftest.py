from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder() -> str:
    """A folder nothing has used before."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def exported(spark, folder):
    """Records as a JSON-lines file, read back with inferred types."""

    def write(*records: dict, root: str = "Item") -> DataFrame:
        path = os.path.join(folder, "part.json")
        with open(path, "w", encoding="utf-8") as file:
            file.write("\n".join(json.dumps({root: record} if root else record) for record in records))
        return spark.read.json(path)

    return write


@pytest.fixture
def frame(spark):
    """DataFrame of rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
