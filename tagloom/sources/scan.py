"""Scans (S1-S10)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tagloom.context import RunContext, fill, unfilled
from tagloom.schema import tagged_read_schema
from tagloom.sources.ledger import take_new_files
from tagloom.sources.variant import read_tagged_variant

Hook = Callable[[DataFrame], DataFrame]

_SELF_DESCRIBING = ("parquet", "orc", "avro")


def read_tagged(
    spark: SparkSession,
    paths: str | Sequence[str],
    root: str | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, Any] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """JSON-lines export files.

    With a declared ``schema`` the files are read once, as the types it implies for the
    struct ``root``; without one Spark infers the types, which reads them twice
    (``options={"samplingRatio": ...}`` shortens the first pass). Lines that are no JSON
    become NULLs, which the key filter removes; ``options={"mode": "FAILFAST"}`` ends the
    read at the first one instead. ``keys`` are declared columns to read from the records'
    key struct as well, with the time of the change.
    """
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        if root is None:
            raise ValueError("a read schema needs the name of the root struct")
        reader = reader.schema(tagged_read_schema(schema, root, keys))
    return reader.json(paths)


def read_format(
    spark: SparkSession,
    data_format: str,
    path: str | Sequence[str],
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Files of any format Spark reads, with its options."""
    reader = spark.read.format(data_format).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def read_partitioned(
    spark: SparkSession, path: str, partition_fields: T.StructType, merge_schema: bool = False
) -> DataFrame:
    """Hive-style partitioned Parquet with the given partition column types.

    Left to itself Spark reads ``month=01`` as the number 1. ``merge_schema`` looks at
    every file, for tables that gained columns over time.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    names = set(partition_fields.names)
    data = [f for f in reader.parquet(path).schema.fields if f.name not in names]
    return spark.read.schema(T.StructType(data + partition_fields.fields)).parquet(path)


def read_catalog(
    spark: SparkSession, database: str | None, table: str, predicate: str | None = None
) -> DataFrame:
    """Catalog table (S4); a ``predicate`` on partition columns limits what is read."""
    df = spark.table(f"{database}.{table}" if database else table)
    return df.where(predicate) if predicate else df


def table_exists(spark: SparkSession, database: str | None, table: str) -> bool:
    """Whether the catalog has this table."""
    return spark.catalog.tableExists(f"{database}.{table}" if database else table)


def dated_path(template: str, context: RunContext) -> str:
    """``template`` with the run date and the other placeholders filled in."""
    path = fill(template, context.placeholders())
    if unfilled(path):
        raise ValueError(f"placeholders without a value in a path: {unfilled(path)}")
    return path


def read_dated(
    spark: SparkSession,
    template: str,
    context: RunContext,
    schema: T.StructType | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The export files of one run date (S2): a concrete path or glob, so only that
    date's folders are listed at all."""
    return read_tagged(spark, dated_path(template, context), context.root, schema, options)


def load_source(
    spark: SparkSession,
    source: Mapping[str, Any],
    context: RunContext,
    schema: T.StructType | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """One source from its description: ``connection_type`` of ``s3_path`` (files, with
    ``s3_details``) or ``catalog`` (``catalog_details``); or the short form with
    ``origin`` of ``s3`` (``bucket``, ``prefix``, ``scheme`` if not ``s3``) or ``catalog`` (``database``,
    ``table_name``). Mode and run date come from ``context`` (S3, S7, S10). JSON is read with
    the tagged form of a declared ``schema`` (and ``keys``, see :func:`read_tagged`), other
    formats with the schema itself, unless their files describe themselves and hold tagged records.
    ``read_schema: variant`` reads JSON by :func:`read_tagged_variant`.

    With a ``ledger`` (a folder) in ``s3_details`` only files that are not in it are read, those
    of the ``days_back`` days before the run date among them. The result's ``taken`` lists them: its
    ``remember()`` enters them into the ledger, which is for the caller to do once what was
    made of them is written. It is None where no ledger is named."""
    source = fill(with_earlier_paths(source, context), context.placeholders())
    kind = source.get("connection_type") or source.get("origin")
    if kind in ("s3_path", "s3"):
        path, data_format, options = _file_source(source, context)
        details = source.get("s3_details") or {}
        if details.get("ledger"):
            taken = take_new_files(spark, [path, *details.get("earlier_paths", ())], details["ledger"], context.run_date)
            df = _load_files(spark, source, taken.paths, data_format, options, context, schema, keys)
            df.taken = taken
            return df
        return _load_files(spark, source, path, data_format, options, context, schema, keys)
    if kind == "catalog":
        details = source.get("catalog_details") or (source if "origin" in source else None)
        if not details or not details.get("table_name"):
            raise ValueError("a catalog source needs catalog_details with a table_name")
        return read_catalog(
            spark,
            details.get("database_template") or details.get("database"),
            details["table_name"],
            _predicate(details),
        )
    raise ValueError(f"unknown kind of source: {kind!r}")


def with_earlier_paths(source: Mapping[str, Any], context: RunContext) -> dict[str, Any]:
    """The source with the paths of ``days_back`` earlier days, made while its templates still have placeholders."""
    details = source.get("s3_details") or {}
    days = int(details.get("days_back") or 0)
    if not days or "earlier_paths" in details:
        return dict(source)
    template = details.get("path_template_inc" if context.incremental else "path_template_full") or ""
    earlier = [replace(context, run_date=context.run_date - timedelta(days=d)) for d in range(1, days + 1)]
    return {**source, "s3_details": {**details, "earlier_paths": [fill(template, day.placeholders()) for day in earlier]}}


def _load_files(
    spark: SparkSession, source: Mapping[str, Any], path: str | list[str], data_format: str, options: dict[str, Any],
    context: RunContext, schema: T.StructType | None, keys: Sequence[str],
) -> DataFrame:
    if not path:
        tagged = tagged_read_schema(schema, context.root, keys) if schema is not None and data_format == "json" else schema
        return spark.createDataFrame([], tagged or T.StructType([]))
    if data_format == "json" and source.get("read_schema") == "variant":
        return read_tagged_variant(spark, path, context.root, options)
    if data_format == "json":
        return read_tagged(spark, path, context.root, schema, options, keys)
    if schema is not None and data_format in _SELF_DESCRIBING:
        found = read_format(spark, data_format, path, options)
        if context.root in found.columns:
            return found
    return read_format(spark, data_format, path, options, schema)


def _file_source(source: Mapping[str, Any], context: RunContext) -> tuple[str, str, dict[str, Any]]:
    if "origin" in source:
        if not source.get("bucket") or not source.get("prefix"):
            raise ValueError("a file source needs a bucket and a prefix")
        scheme = source.get("scheme", "s3")
        return f"{scheme}://{source['bucket']}/{source['prefix']}", source.get("format", "json"), {}
    details = source.get("s3_details")
    if not details:
        raise ValueError("a source of connection_type 's3_path' needs s3_details")
    key = "path_template_inc" if context.incremental else "path_template_full"
    path = details.get(key)
    if not path:
        raise ValueError(f"s3_details needs {key} for mode {context.mode}")
    if "://" not in path and not re.match(r"([A-Za-z][\w+.-]*:)?/", path):  # Hadoop writes file:/x
        raise ValueError(f"{key} has to be an absolute path or a URI: {path!r}")
    return path, details.get("data_format", "json"), dict(details.get("format_options") or {})


def _predicate(details: Mapping[str, Any]) -> str | None:
    """All predicates of a catalog source as one condition."""
    more = details.get("additional_options_templates") or {}
    given = [more.get("catalogPartitionPredicate"), details.get("push_down_predicate_template")]
    return " AND ".join(f"({p})" for p in given if p) or None


def load_sources(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, Any]],
    context: RunContext,
    hooks: Mapping[str, Hook] | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Named sources, each read with the declared schema and passed through the hook of its
    name, if there is one (S7, S8)."""
    hooks, schemas = hooks or {}, schemas or {}
    return {
        name: load_source(spark, source, context, schemas.get(name)).transform(hooks.get(name, lambda df: df))
        for name, source in sources.items()
    }
