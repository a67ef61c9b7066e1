"""Declarative table spec: a dict of plain values to typed, checked settings (M3)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tagloom.context import RunContext, fill, unfilled
from tagloom.operators.changes import CHANGED
from tagloom.plans.steps import check_sql
from tagloom.schema import schema_from_spec
from tagloom.sources.scan import with_earlier_paths

# Output options of a spec and the writer options they set.
_WRITER_OPTIONS = {
    "header": "header",
    "delimiter": "sep",
    "quote": "quote",
    "escape": "escape",
    "encoding": "encoding",
    "date_format": "dateFormat",
    "timestamp_format": "timestampFormat",
    "compression": "compression",
    "null_value": "nullValue",
}

# Options of a CSV output that the spec does not set.
_CSV_DEFAULTS = {
    "header": True,
    "delimiter": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "compression": "none",
}


@dataclass(frozen=True)
class ProcessingSpec:
    """What is done to the rows, in the order :func:`tagloom.plans.transform` does it."""

    schema: T.StructType | None = None
    key_columns: tuple[str, ...] = ()
    order_by_column: str | None = None
    tiebreak_columns: tuple[str, ...] | None = None
    partition_date: str | None = None
    precombine_key: str | None = None
    post_read_filters: tuple[str, ...] = ()
    select_columns: tuple[str, ...] = ()
    rename_columns: tuple[tuple[str, str], ...] = ()
    sql_transformations: tuple[tuple[str, str], ...] = ()
    on_collision: str = "error"
    deletes: str = "ignore"

    @property
    def applies_deletes(self) -> bool:
        return self.deletes == "apply"

    @property
    def row_schema(self) -> T.StructType | None:
        """The declared schema, with the time of the change where deletes are applied."""
        if self.schema is None or not self.applies_deletes:
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(CHANGED, T.LongType())])

    def renamed(self, name: str) -> str:
        """``name`` as it is called after the renames."""
        for old, new in self.rename_columns:
            name = new if name == old else name
        return name

    @property
    def record_keys(self) -> tuple[str, ...]:
        """Columns that identify a row of the finished table: the keys as they are called
        after the renames. The joined id does not: ``a-b`` and ``c``, ``a`` and ``b-c`` have one."""
        return tuple(map(self.renamed, self.key_columns))

    @property
    def key_types(self) -> dict[str, T.DataType]:
        """Declared types of the keys that are not texts."""
        fields = self.schema.fields if self.schema is not None else []
        return {f.name: f.dataType for f in fields if f.name in self.key_columns and not isinstance(f.dataType, T.StringType)}


@dataclass(frozen=True)
class OutputSpec:
    """An extra copy of the result in a format of choice."""

    data_format: str = "csv"
    path: str = ""
    options: Mapping[str, Any] = field(default_factory=dict)
    save_mode: str = "overwrite"
    output_partitions: int | None = None
    data_product: str | None = None
    product_type: str | None = None


@dataclass(frozen=True)
class ExportSpec:
    """Everything that is particular to one table."""

    source: Mapping[str, Any]
    processing: ProcessingSpec
    output: OutputSpec = OutputSpec()
    metadata: Mapping[str, Any] = field(default_factory=dict)

    @property
    def read_schema(self) -> T.StructType | None:
        """Declared schema to read the export with; None leaves its types to inference.

        ``source_config.read_schema: declared`` saves the inference pass over the files.
        It takes declared columns to be attributes of the same name, unless a column
        names its ``Source``. ``variant`` infers the types too, but parses the files once.
        """
        return self.processing.schema if self.source.get("read_schema") == "declared" else None

    @classmethod
    def from_dict(
        cls,
        data: Mapping[str, Any],
        context: RunContext | None = None,
        schemas: Mapping[str, Any] | None = None,
    ) -> ExportSpec:
        """Spec of a dict with ``process_metadata``, ``source_config``,
        ``processing_config`` and ``output_config``.

        The declared schema is ``processing_config.schema`` (a list of column specs),
        or the one called ``schema_name`` in ``schemas``. Placeholders are filled in
        from ``context``. What is missing or malformed raises ``ValueError``; so do, where a
        session is active, keys, selections and SQL that do not fit the declared columns.
        """
        if not data:
            raise ValueError("empty spec")
        if context is not None:
            if data.get("source_config"):
                data = {**data, "source_config": with_earlier_paths(data["source_config"], context)}
            data = fill(dict(data), context.placeholders())
            # A reader takes braces for a pattern: a misspelt name would match nothing, or too much.
            left = unfilled([data.get("source_config"), (data.get("output_config") or {}).get("path_template")])
            if left:
                raise ValueError(f"placeholders without a value: {left}")
        source = data.get("source_config")
        if not source:
            raise ValueError("the spec has no source_config")
        if source.get("read_schema", "inferred") not in ("inferred", "declared", "variant"):
            raise ValueError(f"read_schema is 'inferred', 'declared' or 'variant', not {source['read_schema']!r}")
        processing = _processing(data.get("processing_config") or {}, schemas or {})
        if source.get("read_schema") == "declared" and processing.schema is None:
            raise ValueError("read_schema is 'declared', but the spec declares no schema")
        session = SparkSession.getActiveSession()
        if context is not None and session is not None:
            check_sql(session, processing)
        return cls(
            source=source,
            processing=processing,
            output=_output(data.get("output_config") or {}),
            metadata=data.get("process_metadata") or {},
        )

    @classmethod
    def from_yaml(
        cls,
        text: str,
        context: RunContext | None = None,
        schemas: Mapping[str, Any] | None = None,
    ) -> ExportSpec:
        """Spec of a YAML text; needs the ``yaml`` module."""
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading YAML needs the yaml module; use from_dict") from missing
        return cls.from_dict(yaml.safe_load(text), context, schemas)


def _processing(config: Mapping[str, Any], schemas: Mapping[str, Any]) -> ProcessingSpec:
    name = config.get("schema_name")
    columns = config.get("schema") or schemas.get(name)
    if name and columns is None:
        raise ValueError(f"no schema called {name!r} was given; there are {sorted(schemas)}")
    ties = config.get("tiebreak_columns")
    if config.get("on_collision", "error") not in ("error", "coalesce"):
        raise ValueError(f"on_collision is 'error' or 'coalesce', not {config['on_collision']!r}")
    if config.get("deletes", "ignore") not in ("ignore", "apply"):
        raise ValueError(f"deletes is 'ignore' or 'apply', not {config['deletes']!r}")
    if config.get("deletes") == "apply" and not config.get("key_columns"):
        raise ValueError("deletes are applied by key: the spec needs key_columns")
    return ProcessingSpec(
        schema=schema_from_spec(columns) if columns is not None else None,
        key_columns=_names(config, "key_columns"),
        order_by_column=config.get("order_by_column") or None,
        tiebreak_columns=tuple(ties) if ties is not None else None,
        partition_date=config.get("partition_date") or None,
        precombine_key=config.get("precombine_key") or None,
        post_read_filters=_names(config, "post_read_filters"),
        select_columns=_names(config, "select_columns"),
        rename_columns=_pairs(config, "rename_columns", "old_name", "new_name"),
        sql_transformations=_pairs(config, "sql_transformations", "name", "sql"),
        on_collision=config.get("on_collision", "error"),
        deletes=config.get("deletes", "ignore"),
    )


def _names(config: Mapping[str, Any], key: str) -> tuple[str, ...]:
    value = config.get(key) or ()
    if isinstance(value, str):
        raise ValueError(f"{key} has to be a list, not the text {value!r}")
    return tuple(value)


def _pairs(config: Mapping[str, Any], key: str, first: str, second: str) -> tuple[tuple[str, str], ...]:
    items = config.get(key) or ()
    for item in items:
        if not isinstance(item, Mapping) or set(item) != {first, second}:
            raise ValueError(f"each of {key} has to have {first} and {second}: {item!r}")
    return tuple((item[first], item[second]) for item in items)


def _output(config: Mapping[str, Any]) -> OutputSpec:
    options = config.get("options") or {}
    unknown = set(options) - set(_WRITER_OPTIONS)
    if unknown:
        raise ValueError(f"unknown output options {sorted(unknown)}")
    data_format = config.get("format", "csv")
    if data_format == "csv":
        options = _CSV_DEFAULTS | dict(options)
    return OutputSpec(
        data_format=data_format,
        path=config.get("path_template", ""),
        options={_WRITER_OPTIONS[k]: v for k, v in options.items() if v is not None},
        save_mode=config.get("save_mode", "overwrite"),
        output_partitions=config.get("output_partitions"),
        data_product=config.get("data_product"),
        product_type=config.get("product_type"),
    )
