"""Keyed upsert into a partitioned copy-on-write table (K4)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.names import literal_path, quoted
from tagloom.operators.shape import latest_per_key
from tagloom.scratch import discard, scratch_path
from tagloom.scratch import staged as stage

_CHUNK, _INCOMING, _MATCHED, _DELETED_AT = (f"__tagloom_{name}" for name in ("chunk", "incoming", "matched", "deleted_at"))

#: The table's columns and types, in a file that readers of the folder pass over.
_SCHEMA_FILE = "_tagloom_schema.json"

# How Spark names the folder of a partition value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | frozenset(map(chr, range(1, 32)))


class UnfinishedCommit(RuntimeError):
    """Merged partitions are written, but not all of them have replaced the stored ones.

    ``resume_from`` is the folder they are in; giving it to :func:`upsert` finishes the commit.
    """

    def __init__(self, path: str, resume_from: str) -> None:
        super().__init__(f"commit to {path} failed; finish it with upsert(..., resume_from={resume_from!r})")
        self.resume_from = resume_from


@dataclass(frozen=True)
class Merged:
    """Rows merged in (one per key and partition) and stored rows that deletes removed."""

    rows: int
    deleted: int = 0


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    precombine: str,
    partition_by: Sequence[str] = ("year", "month", "day"),
    *,
    staged: bool = False,
    unique: bool = False,
    rows_per_file: int = 1_000_000,
    partitions_at_once: int = 2_000,
    resume_from: str | None = None,
) -> int:
    """Merge ``df`` into the Parquet table at ``path``; returns the rows merged in (one per key).

    Per (partition, key) one row stays: the one with the greatest ``precombine``, NULL
    being lowest; on a tie the incoming row wins. A key whose partition changed is thus
    kept in both partitions. Columns new in ``df`` are added, columns it lacks become
    NULL in its rows (the same goes for fields of struct columns). A column may have a wider
    type than the table (see :func:`wider_type`), which has that type from then on; a column of
    any other type than anywhere in the table is refused. A NULL key ends the job. In text
    partition columns ``''`` is NULL, as a folder cannot tell them apart.

    How it runs: the batch is reduced to one row per key and written once (skipped with
    ``staged``, for a DataFrame that is a plain scan of files already; ``unique`` says
    that it holds one row per key). Touched partitions are merged ``partitions_at_once``
    at a time, which only groups the work; of the table only their folders are looked at.
    A join with the batch's partitions, keys and precombine values drops the stored rows
    that lose; the incoming rows that win are added; partitions are rebalanced, so small
    ones are single files and a hot one is written by many tasks.

    All merged partitions are written to a scratch folder first and replace the stored ones
    in a second write. Spark deletes a partition before it moves the new one into place, so
    a crash in the second write can leave partitions missing. They are in the scratch
    folder: :class:`UnfinishedCommit` names it (after a lost driver it is the newest
    ``upsert-merged-*`` below the folder of :mod:`tagloom.scratch`), and ``resume_from`` repeats the second
    write from it, which needs ``path`` and ``partition_by`` alone and may be done any number
    of times. Scratch folders are deleted after success. One writer at a time.
    """
    if resume_from:
        return _commit(df.sparkSession, resume_from, path, partition_by, rows_per_file, None)
    return apply_changes(
        df, None, path, keys, precombine, partition_by,
        staged=staged, unique=unique, rows_per_file=rows_per_file, partitions_at_once=partitions_at_once,
    ).rows


def apply_changes(
    df: DataFrame,
    deletes: DataFrame | None,
    path: str,
    keys: Sequence[str],
    precombine: str,
    partition_by: Sequence[str] = ("year", "month", "day"),
    *,
    changed: str | None = None,
    outlived: bool = False,
    staged: bool = False,
    unique: bool = False,
    rows_per_file: int = 1_000_000,
    partitions_at_once: int = 2_000,
) -> Merged:
    """:func:`upsert` of ``df`` after ``deletes``: a DataFrame of the keys of deleted rows.

    ``changed`` names a column that ``df`` and ``deletes`` both have, the time of a change. A
    delete removes the rows of its key whose change is earlier or unknown, stored ones in any
    partition as well as those of ``df``; a row changed at the same time or later stays, and
    a stored row that is deleted no longer competes, whatever its ``precombine``. So a delete
    followed by a new row of the key, in one batch or several, leaves the new row, and a batch
    may be applied again. Without ``changed``, or where ``df`` has ``outlived`` them
    already, deletes precede all rows of ``df``. A key with a NULL names no row. Deletes are not kept: a batch older than one of them, applied after
    it, brings its rows back.

    As a delete does not say which partition its rows are in, the key columns of the whole table
    are read, and joined with one row per deleted key; partitions left without rows are removed.
    """
    spark = df.sparkSession
    for name in (*keys, precombine, *partition_by, *([changed] if changed else [])):
        if name not in df.columns:
            raise ValueError(f"upsert needs column {name!r}; columns are {df.columns}")
    if not keys:
        raise ValueError("upsert needs at least one key column")
    texts = [f.name for f in df.schema.fields if f.name in partition_by and isinstance(f.dataType, T.StringType)]
    df = df.withColumns({name: F.nullif(F.col(quoted(name)), F.lit("")) for name in texts})
    stored_schema = _stored_schema(spark, path, T.StructType([df.schema[name] for name in partition_by]))
    _check_types(stored_schema, df.schema, partition_by)
    table = _widened(stored_schema, df.schema, partition_by)

    temporary: list[str] = []
    dead: DataFrame | None = None
    if deletes is not None:
        tombstones, folder = stage(_tombstones(deletes, keys, changed), "upsert-deletes", with_path=True)
        temporary.append(folder)
        if changed and not outlived:
            df, staged = _outliving(df, tombstones, keys, changed), False
        if stored_schema is not None:
            everything = spark.read.schema(table).parquet(path)
            dead, folder = stage(_dead(everything, tombstones, keys, changed, partition_by), "upsert-dead", with_path=True)
            temporary.append(folder)
    batch = df if unique else latest_per_key(df, [*partition_by, *keys], precombine)
    if not staged:
        batch, folder = stage(batch, "upsert", with_path=True)
        temporary.append(folder)
    places = batch.select(*map(quoted, partition_by))
    if dead is not None:
        places = places.union(dead.select(*map(quoted, partition_by)))
    groups, chunks = _chunks(places, partition_by, partitions_at_once)
    if not chunks:
        discard(spark, *temporary)
        return Merged(0)
    if groups > 1:  # each chunk is to read its own rows only
        folder = scratch_path(spark, "upsert-chunks")
        numbered = batch.withColumn(_CHUNK, _chunk_of(partition_by, groups))
        numbered.hint("rebalance", _CHUNK).write.partitionBy(_CHUNK).parquet(folder)
        batch = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField(_CHUNK, T.IntegerType())])).parquet(folder)
        temporary.append(folder)
    merged, replaced = scratch_path(spark, "upsert-merged"), []
    for chunk, names in chunks.items():
        incoming = batch.where(F.col(_CHUNK) == chunk).drop(_CHUNK) if groups > 1 else batch
        checked = incoming.withColumns({k: _never_null(k) for k in keys})
        there = _existing(spark, path, names)
        replaced += there
        rows = checked
        if there:
            stored = _stored_rows(spark, path, there, table)
            if dead is not None:
                gone = dead.where(_chunk_of(partition_by, groups) == chunk) if groups > 1 else dead
                stored = stored.join(gone, _same(stored, gone, [*partition_by, *keys]), "left_anti")
            rows = _merged(stored, checked, keys, precombine, partition_by)
        full = rows.unionByName(spark.createDataFrame([], table), allowMissingColumns=True).select(*map(quoted, table.names))
        (
            full.hint("rebalance", *map(quoted, partition_by))
            .write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(merged)
        )
    _keep_schema(spark, path, table)
    counts = Merged(batch.count(), dead.count() if dead is not None else 0)
    if dead is not None:
        # The second write replaces what has rows. All rows of these are deleted: again, after a crash.
        left = set(_existing(spark, merged, replaced))
        discard(spark, *(f"{path}/{folder}" for folder in replaced if folder not in left))
    _commit(spark, merged, path, partition_by, rows_per_file, table)
    discard(spark, *temporary)
    return counts


# --- deletes -----------------------------------------------------------------------------


def _gone(i: int) -> str:
    return f"__tagloom_gone_{i}"


def _tombstones(deletes: DataFrame, keys: Sequence[str], changed: str | None) -> DataFrame:
    """One row per deleted key: the key under names of its own, and the time of the last delete."""
    named = deletes.select(
        *[F.col(quoted(key)).alias(_gone(i)) for i, key in enumerate(keys)], (F.col(quoted(changed)) if changed else F.lit(None)).alias(_DELETED_AT)
    ).dropna(subset=[_gone(i) for i in range(len(keys))])
    return named.groupBy(*[_gone(i) for i in range(len(keys))]).agg(F.max(_DELETED_AT).alias(_DELETED_AT))


def _of_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(quoted(key)) == F.col(_gone(i)) for i, key in enumerate(keys)])


def _outlived(changed: str | None) -> Column:
    """Whether a delete is later than the row: also where either time is unknown."""
    return F.coalesce(F.col(quoted(changed)) < F.col(_DELETED_AT), F.lit(True)) if changed else F.lit(True)


def _outliving(df: DataFrame, tombstones: DataFrame, keys: Sequence[str], changed: str) -> DataFrame:
    return df.join(tombstones, _of_key(keys) & _outlived(changed), "left_anti")


def _dead(stored: DataFrame, tombstones: DataFrame, keys: Sequence[str], changed: str | None, partition_by: Sequence[str]) -> DataFrame:
    """(partition, key) of the stored rows that are deleted; of the table only these columns are read."""
    return stored.join(tombstones, _of_key(keys) & _outlived(changed)).select(*map(quoted, [*partition_by, *keys]))


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[quoted(c)].eqNullSafe(right[quoted(c)]) for c in columns])


def _commit(spark, merged: str, path: str, partition_by, rows_per_file: int, table: T.StructType | None) -> int:
    """Replace the stored partitions by the merged ones; returns their rows."""
    if table is None:
        known = _kept_schema(spark, path)
        if known is None:
            raise ValueError(f"{path} has no {_SCHEMA_FILE}: nothing was begun that could be resumed")
        table = known
    rows = spark.read.schema(table).parquet(merged)
    try:
        _swap(rows, path, partition_by, rows_per_file)
    except Exception as cause:
        raise UnfinishedCommit(path, merged) from cause
    count = rows.count()
    discard(spark, merged)
    return count


def _swap(rows: DataFrame, path: str, partition_by, rows_per_file: int) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(path)


# --- touched partitions ------------------------------------------------------------------


def _chunk_of(partition_by: Sequence[str], chunks: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quoted(name)) for name in partition_by]), F.lit(chunks)).cast("int")


def _chunks(places: DataFrame, partition_by: Sequence[str], at_once: int) -> tuple[int, dict[int, list[str]]]:
    """Folders of the touched partitions in groups of about ``at_once``, and the number of groups.

    The names of a table's partitions are what its readers list as well.
    """
    names = [F.col(quoted(name)) for name in partition_by]
    touched = places.select(*names).distinct()
    texts = [F.col(quoted(name)).cast("string").alias(f"p{i}") for i, name in enumerate(partition_by)]
    # One job where one group holds all of them.
    rows, chunks = touched.select(F.lit(0).alias("chunk"), *texts).limit(at_once + 1).collect(), 1
    if len(rows) > at_once:
        chunks = -(-touched.count() // at_once)
        rows = touched.select(_chunk_of(partition_by, chunks).alias("chunk"), *texts).toLocalIterator()
    out: dict[int, list[str]] = {}
    for row in rows:
        folder = "/".join(f"{_escaped(name)}={_folder_value(row[i + 1])}" for i, name in enumerate(partition_by))
        out.setdefault(row.chunk, []).append(folder)
    return chunks, dict(sorted(out.items()))


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def _folder_value(value: str | None) -> str:
    return _NULL_FOLDER if value is None else _escaped(value)


def _existing(spark: SparkSession, path: str, folders: list[str]) -> list[str]:
    """Which of these folders there are; the folder around them is listed, once for all in it."""
    files = _file_system(spark, path)
    siblings: dict[str, list[str]] = {}
    for folder in folders:
        parent, _, name = f"{path}/{folder}".rpartition("/")
        siblings.setdefault(parent, []).append(name)
    there = set()
    for parent, names in siblings.items():
        at = _path(spark, parent)
        if files.exists(at):
            listed = {status.getPath().getName() for status in files.listStatus(at)}
            there.update(f"{parent}/{name}" for name in listed.intersection(names))
    return [folder for folder in folders if f"{path}/{folder}" in there]


def _stored_rows(spark: SparkSession, path: str, folders: list[str], table: T.StructType) -> DataFrame:
    """The rows of these partitions, with all columns of the table."""
    # A path is a pattern to the reader; partition values may hold the pattern's signs.
    return spark.read.option("basePath", path).schema(table).parquet(*[literal_path(f"{path}/{folder}") for folder in folders])


def _merged(stored: DataFrame, incoming: DataFrame, keys, precombine: str, partition_by) -> DataFrame:
    """Stored rows that stay and incoming ones that win."""
    columns = [*partition_by, *keys]
    new, old = F.col(_INCOMING), F.col(quoted(precombine))
    narrow = incoming.select(*[F.col(quoted(c)).alias(f"__tagloom_key_{i}") for i, c in enumerate(columns)], F.col(quoted(precombine)).alias(_INCOMING), F.lit(True).alias(_MATCHED))
    same = reduce(and_, [F.col(quoted(c)).eqNullSafe(F.col(f"__tagloom_key_{i}")) for i, c in enumerate(columns)])
    stays = F.coalesce(old.isNotNull() & (new.isNull() | (old > new)), F.lit(False))
    kept = stored.join(narrow, same, "left").where(F.col(_MATCHED).isNull() | stays).select(*map(quoted, stored.columns))
    beaten = stored.join(narrow, same).where(stays).select(*[F.col(f"__tagloom_key_{i}") for i in range(len(columns))])
    wins = incoming.join(beaten, same, "left_anti")
    return kept.unionByName(wins, allowMissingColumns=True)


# --- the table's schema ------------------------------------------------------------------


def _stored_schema(spark: SparkSession, path: str, partitions: T.StructType) -> T.StructType | None:
    """Columns of the whole table; None before the first write.

    A table without the schema file (made by another writer) has its footers read, once.
    """
    kept = _kept_schema(spark, path)
    if kept is not None:
        return kept
    if not _file_system(spark, path).exists(_path(spark, path)):
        return None
    try:
        reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", False)
        merged = reader.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    return T.StructType([f for f in merged.fields if f.name not in partitions.names] + partitions.fields)


def _widened(table: T.StructType | None, batch: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """The table's columns and those the batch adds, partition columns last, all nullable."""
    data = [f for f in (table or batch).fields if f.name not in partition_by]
    have = {f.name: i for i, f in enumerate(data)}
    for field in batch.fields:
        if field.name in have:
            i = have[field.name]
            data[i] = T.StructField(field.name, _wider(data[i].dataType, field.dataType))
        elif field.name not in partition_by:
            data.append(T.StructField(field.name, field.dataType))
    return T.StructType([T.StructField(f.name, f.dataType) for f in data] + [T.StructField(n, batch[n].dataType) for n in partition_by])


def _wider(stored: T.DataType, incoming: T.DataType) -> T.DataType:
    """The type of a column after the merge: fields of both, the incoming type where it is wider."""
    if isinstance(stored, T.StructType) and isinstance(incoming, T.StructType):
        theirs = {f.name: f.dataType for f in incoming.fields}
        both = [T.StructField(f.name, _wider(f.dataType, theirs[f.name]) if f.name in theirs else f.dataType) for f in stored.fields]
        return T.StructType(both + [f for f in incoming.fields if f.name not in stored.names])
    if isinstance(stored, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(_wider(stored.elementType, incoming.elementType))
    return incoming if wider_type(stored, incoming) else stored


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider_type(stored: T.DataType, incoming: T.DataType) -> bool:
    """Whether ``incoming`` holds every value of ``stored`` and files of ``stored`` can be read as it.

    A longer whole number, ``double`` for ``float`` or a whole number of up to 32 bits, a
    decimal with more digits on either side and fewer on none, or one with room for a whole number.
    """
    if isinstance(stored, T.DecimalType) and isinstance(incoming, T.DecimalType):
        whole, fraction = (t.precision - t.scale for t in (stored, incoming)), (stored.scale, incoming.scale)
        old, new = whole
        return new >= old and fraction[1] >= fraction[0] and (new, fraction[1]) != (old, fraction[0])
    if not isinstance(stored, (*_WHOLE, T.FloatType)):
        return False
    if isinstance(incoming, T.DoubleType):
        return isinstance(stored, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(stored, T.FloatType):
        return False
    if isinstance(incoming, T.DecimalType):
        return incoming.precision - incoming.scale >= (20 if isinstance(stored, T.LongType) else 10)
    return isinstance(incoming, _WHOLE) and _WHOLE.index(type(incoming)) > _WHOLE.index(type(stored))


def is_upserted(spark: SparkSession, path: str) -> bool:
    """Whether there is an upserted table at ``path``."""
    return _kept_schema(spark, path) is not None


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The upserted table at ``path`` with all its columns, in the widest type each has had."""
    schema = _kept_schema(spark, path)
    if schema is None:
        raise ValueError(f"{path} is no table that was upserted: it has no {_SCHEMA_FILE}")
    return spark.read.schema(schema).parquet(path)


def _kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    files, file = _file_system(spark, path), _path(spark, f"{path}/{_SCHEMA_FILE}")
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def _keep_schema(spark: SparkSession, path: str, table: T.StructType) -> None:
    """Written before the rows are: columns the file lacks would be lost in the next upsert."""
    files, final = _file_system(spark, path), _path(spark, f"{path}/{_SCHEMA_FILE}")
    fresh = _path(spark, f"{path}/{_SCHEMA_FILE}.new")
    out = files.create(fresh, True)
    out.write(bytearray(table.json().encode()))
    out.close()
    files.delete(final, False)
    files.rename(fresh, final)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _check_types(stored: T.StructType | None, batch: T.StructType, partition_by: Sequence[str]) -> None:
    have = {f.name: f.dataType for f in stored.fields} if stored is not None else {}
    wrong = {
        f.name: (have[f.name].simpleString(), f.dataType.simpleString())
        for f in batch.fields
        if f.name in have and not _fits(have[f.name], f.dataType, f.name not in partition_by)
    }
    if wrong:
        raise ValueError(f"columns stored with another type (stored, incoming): {wrong}")


def _fits(stored: T.DataType, incoming: T.DataType, widen: bool = True) -> bool:
    """Whether two types are the same but for fields only one of them has and wider incoming ones."""
    if isinstance(stored, T.StructType) and isinstance(incoming, T.StructType):
        common = set(stored.names) & set(incoming.names)
        return all(_fits(stored[n].dataType, incoming[n].dataType, widen) for n in common)
    if isinstance(stored, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return _fits(stored.elementType, incoming.elementType, widen)
    return stored.simpleString() == incoming.simpleString() or (widen and wider_type(stored, incoming))


def _never_null(key: str) -> Column:
    return F.coalesce(F.col(quoted(key)), F.raise_error(F.lit(f"record key {key} is NULL")))
