"""Run queries and their SQL side by side and compare the rows as multisets."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from decimal import Decimal
from typing import Any

from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def _value(value: Any) -> Any:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def oracle_connection(sf_dir: str):
    """DuckDB with every test table as a view."""
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark: SparkSession, sf_dir: str, name: str, connection) -> str | None:
    """What differs between a query and its SQL; None if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns: query {sorted(df.columns)}, SQL {sorted(columns)}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    if mine == theirs:
        return None
    extra, missing = mine - theirs, theirs - mine
    return (
        f"rows: query {mine.total()}, SQL {theirs.total()}; only in query {extra.total()}, e.g. "
        f"{next(iter(extra), None)}; only in SQL {missing.total()}, e.g. {next(iter(missing), None)}"
    )
