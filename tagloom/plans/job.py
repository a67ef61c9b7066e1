"""The composed job: scan, transform, metadata, table, upsert (M2, M4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagloom.context import RunContext
from tagloom.functions.names import quoted
from tagloom.operators import (
    add_metadata,
    align,
    flatten_tagged,
    is_empty,
    keep_keyed,
    latest_per_key,
    select_columns,
    split_rejects,
)
from tagloom.operators.align import cast_sql
from tagloom.operators.changes import CHANGED, change_time, deleted_keys, gone_name, outliving, tombstones
from tagloom.operators.metadata import DEFAULT_PARTITION_DATE, PARTITION_COLUMNS
from tagloom.plans.spec import ExportSpec, ProcessingSpec
from tagloom.plans.steps import shaped
from tagloom.scratch import discard, staged
from tagloom.sinks import apply_changes, read_upserted, write_files, write_table
from tagloom.sinks.merge import Merged, is_upserted
from tagloom.sources import Hook, load_source

_IMAGE, _REJECTS = "__tagloom_image", "__tagloom_rejects"


@dataclass(frozen=True)
class JobResult:
    """What a run did.

    ``rows`` in the table it wrote, whether it ``upserted`` them, how many keys (per partition)
    it ``merged`` and how many stored rows its deletes removed (``deleted``). Counted while
    the export was read: its ``records``, those with an image (``images``) and with all keys
    (``keyed``), and the records of deletes (``deletes``, where they are applied). ``rejected`` are the
    values that did not fit their type, where the job was given a folder for them.
    """

    rows: int
    upserted: bool
    merged: int = 0
    deleted: int = 0
    records: int = 0
    images: int = 0
    keyed: int = 0
    deletes: int = 0
    rejected: int = 0


def transform(df: DataFrame, spec: ExportSpec, context: RunContext) -> DataFrame:
    """Export records to finished rows, lazily.

    In this order: flatten, keep rows with all keys (that no later delete removes, where
    deletes are applied), latest row per key, align, joined id, sorted columns, time
    column, filters, selection, renames, SQL columns.
    """
    return _finished(_flattened(df, spec, context), spec, context)


def _flattened(df: DataFrame, spec: ExportSpec, context: RunContext) -> DataFrame:
    """One projection of all records: the columns of images, whether there is one, and where
    deletes are applied the time of the change and the keys of deleted items."""
    work, there = spec.processing, context.root in df.columns
    extra = [F.col(quoted(context.root)).isNotNull().alias(_IMAGE) if there else F.lit(False).alias(_IMAGE)]
    if work.applies_deletes:
        extra.append(change_time(df))
        if context.incremental:
            extra += deleted_keys(df, context.root, work.key_columns, work.schema)
    if not there and work.applies_deletes:
        return df.select(*extra)
    flat = flatten_tagged(df, context.root, work.schema, work.on_collision, extra)
    if work.applies_deletes and flat.columns.count(CHANGED) > 1:
        raise ValueError(f"an attribute has the name {CHANGED!r}, which deletes need for the time of the change")
    return _needed(flat, work)


def _finished(flat: DataFrame, spec: ExportSpec, context: RunContext, rejects: bool = False) -> DataFrame:
    work = spec.processing
    images = keep_keyed(flat.drop(_IMAGE), work.key_columns)
    if work.applies_deletes and context.incremental:
        images = outliving(images, tombstones(flat, work.key_columns, work.key_types), work.key_columns, work.key_types)
    latest = latest_per_key(
        images,
        work.key_columns,
        work.order_by_column,
        order_type=_order_type(work),
        tiebreak=work.tiebreak_columns,
        key_types={key: kind for key, kind in work.key_types.items() if key in images.columns},
    )
    aligned = align(latest, work.row_schema, rejects=_REJECTS if rejects else None) if work.row_schema is not None else latest
    own = [CHANGED] * work.applies_deletes + [_REJECTS] * rejects
    return shaped(aligned, work, own)


def _needed(df: DataFrame, work: ProcessingSpec) -> DataFrame:
    """Only what aligning keeps, so that undeclared columns are not shuffled."""
    if work.schema is None:
        return df
    own = {_IMAGE, CHANGED, *map(gone_name, range(len(work.key_columns)))}
    wanted = {*work.schema.names, *work.key_columns, *(work.tiebreak_columns or ()), work.order_by_column, *own}
    return select_columns(df, [name for name in df.columns if name in wanted])


def _order_type(work: ProcessingSpec):
    if work.schema is None or work.order_by_column not in work.schema.names:
        return None
    return work.schema[work.order_by_column].dataType


def with_metadata(df: DataFrame, spec: ExportSpec, context: RunContext) -> DataFrame:
    """Add ingestion metadata; the partition column is found under its new name too."""
    column = spec.processing.partition_date or DEFAULT_PARTITION_DATE
    return add_metadata(
        df, context.run_date, spec.processing.renamed(column), ingested_at=context.ingested_at
    )


def build(
    spark: SparkSession, spec: ExportSpec, context: RunContext, hook: Hook | None = None
) -> DataFrame | None:
    """Scan, transform and add metadata; None if the source has no rows to take."""
    keys = spec.processing.key_columns if spec.processing.applies_deletes else ()
    source = load_source(spark, spec.source, context, spec.read_schema, keys)
    if hook is not None:
        source = hook(source)
    if _nothing_in(source, context):
        return None
    return with_metadata(transform(source, spec, context), spec, context)


def _nothing_in(source: DataFrame, context: RunContext) -> bool:
    """Whether no record has an image: no records, or change files of nothing but deletes,
    which an inferred read has no column for and a declared one NULLs."""
    if context.root not in source.columns:
        return context.incremental or is_empty(source)
    return is_empty(source.where(F.col(quoted(context.root)).isNotNull()))


def _watched(flat: DataFrame, work: ProcessingSpec, observation: Observation) -> DataFrame:
    """Rows with all keys and deletes, every record counted on the way.

    Misfits are keys that are there but do not fit their declared type.
    """
    keys = [key for key in work.key_columns if key in flat.columns]
    gone = [gone_name(i) for i in range(len(work.key_columns)) if gone_name(i) in flat.columns]
    keyed = " AND ".join(f"{quoted(key)} IS NOT NULL" for key in keys) if keys or not work.key_columns else "false"
    deleted = " AND ".join(f"{name} IS NOT NULL" for name in gone) or "false"
    given = {key: key for key in keys} | dict(zip(work.key_columns, gone))
    unfit = [
        f"{quoted(name)} IS NOT NULL AND {cast_sql(quoted(name), flat.schema[name].dataType, kind)} IS NULL"
        for key, kind in work.key_types.items()
        for name in {key, given.get(key, key)}
        if name in flat.columns
    ]
    counts = {
        "records": F.count(F.lit(1)),
        "images": F.count_if(F.col(_IMAGE)),
        "keyed": F.count_if(F.expr(f"{_IMAGE} AND ({keyed or 'true'})")),
        "deletes": F.count_if(F.expr(deleted)),
        "misfits": F.count_if(F.expr(f"(({keyed or 'true'}) OR {deleted}) AND ({' OR '.join(unfit) or 'false'})")),
    }
    counted = flat.observe(observation, *[count.alias(name) for name, count in counts.items()])
    return counted.where(f"({_IMAGE} AND ({keyed or 'true'})) OR ({deleted})").drop(_IMAGE)


def run_job(
    spark: SparkSession,
    spec: ExportSpec,
    context: RunContext,
    *,
    table: str,
    table_path: str | None = None,
    curated_path: str | None = None,
    rejects_path: str | None = None,
    hook: Hook | None = None,
    files: int | None = None,
) -> JobResult | None:
    """The whole job for one table and run date; None if there was nothing to do.

    The export is parsed once: its flattened records are written to scratch and counted on the
    way. Nothing else is written if none has an image, or if keys do not fit their
    declared type, which ends the job with their number: as NULLs they would overwrite each
    other. Then ``table`` is written (replaced, in ``files`` files if given), and from its
    files the declared extra output and the upsert into ``curated_path``, by the key columns.
    With ``rejects_path`` the values of the table's rows that did not fit their declared type,
    NULL there, are written to that folder (replaced), a row for each with the row's keys.
    Where the spec says ``deletes: apply``, rows of deleted items leave ``curated_path``. Where its
    source names a ``ledger``, only files that it does not list are read, and it lists them afterwards.
    """
    work = spec.processing
    if curated_path and not (work.record_keys and work.precombine_key):
        raise ValueError("an upsert needs key_columns and a precombine_key")
    if rejects_path and work.schema is None:
        raise ValueError("values are rejected by a declared schema, and the spec has none")
    source = load_source(spark, spec.source, context, spec.read_schema, work.key_columns if work.applies_deletes else ())
    temporary = [source.staged_path] if hasattr(source, "staged_path") else []
    taken = getattr(source, "taken", None)
    if taken is not None:
        temporary.append(taken.folder)
    if hook is not None:
        source = hook(source)
    try:
        if taken is not None and taken.files.isEmpty():
            return None
        if context.root not in source.columns and not work.applies_deletes and _nothing_in(source, context):
            return None
        observation = Observation()
        flat, folder = staged(_watched(_flattened(source, spec, context), work, observation), "job", with_path=True)
        temporary.append(folder)
        counts = dict(observation.get)
        misfits = counts.pop("misfits")
        if misfits:
            raise ValueError(f"{misfits} rows have keys that do not fit their declared types {work.key_types}")
        result = None
        if counts["images"] or counts["deletes"]:
            result = _written(spark, flat, counts, spec, context, table, table_path, curated_path, rejects_path, files, temporary)
        if taken is not None:
            taken.remember()
        return result
    finally:
        discard(spark, *temporary)


def _written(
    spark, flat: DataFrame, counts: dict[str, int], spec: ExportSpec, context: RunContext, table, table_path, curated_path, rejects_path, files, temporary: list[str]
) -> JobResult | None:
    """All writes of :func:`run_job`, from the flattened records; adds folders to delete to ``temporary``."""
    work = spec.processing
    changed = work.renamed(CHANGED) if work.applies_deletes else None
    deletes = None
    if work.applies_deletes and context.incremental:
        deletes = tombstones(flat, work.key_columns, work.key_types).toDF(*work.record_keys, changed)
    if not counts["images"]:
        if not curated_path or not is_upserted(spark, curated_path):
            return None
        none = read_upserted(spark, curated_path).limit(0)
        done = apply_changes(none, deletes, curated_path, work.record_keys, work.renamed(work.precombine_key), PARTITION_COLUMNS, changed=changed)
        return JobResult(0, True, 0, done.deleted, **counts)
    result = with_metadata(_finished(flat.withColumn(_IMAGE, F.lit(True)), spec, context, bool(rejects_path)), spec, context)
    missing = [name for name in work.record_keys if name not in result.columns]
    if curated_path and missing:
        raise ValueError(f"an upsert needs the key columns {missing}, which the spec's selection leaves out")
    if rejects_path:  # made once, for the table and the rejects
        result, folder = staged(result, "job-result", with_path=True)
        temporary.append(folder)
        result, rejects = split_rejects(result, _REJECTS, [name for name in work.record_keys if name in result.columns])
        write_files(rejects, rejects_path)
        counts["rejected"] = spark.read.schema(rejects.schema).parquet(rejects_path).count()
    written = write_table(result, table, table_path, files=files)
    if spec.output.path:
        write_files(
            written,
            spec.output.path,
            data_format=spec.output.data_format,
            mode=spec.output.save_mode,
            files=spec.output.output_partitions,
            options=spec.output.options,
        )
    done = Merged(0)
    if curated_path:
        done = apply_changes(
            written,
            deletes,
            curated_path,
            work.record_keys,
            work.renamed(work.precombine_key),
            PARTITION_COLUMNS,
            changed=changed,
            outlived=True,
            staged=True,
            unique=bool(work.order_by_column),
        )
    # counted from the footers of the files just written
    return JobResult(written.count(), bool(curated_path), done.rows, done.deleted, **counts)
