"""Exact deduplication by streaming queries whose keyed state lies on disk and never expires.

Two queries follow each other; both go on where they stopped, so a later call with the same
``state`` folder reads only the files that are new.

1. *rows*: the digest of each text with the row's id and its locator (file and row number).
2. *groups*: an aggregation by digest without a watermark, kept in RocksDB. For every text ever
   seen the state retains its digest, the identifier that stays so far, the locator of one of
   its texts, and how many there are. Rows are combined before they are shuffled, so a text
   that fills a third of the table reaches its task as one row from each other task.

A digest is no proof. Rows whose digest is known are hits: their texts, and the one at the
locator in the state, are read back from the table and compared byte by byte, the smallest of a
digest against the largest. Digests with differing texts are grouped anew by the texts themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom import scratch
from tagloom.llm.common import staged

_CHUNK = 4096  # rows of a file that share a join key
_KEEP = "struct<has_id:boolean,id:{},file:string,row:long>"


def exact_duplicates(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    state: str | None = None,
    files_per_batch: int = 10_000,
    digest: Callable[[Column], Column] = lambda body: F.sha2(body, 256),
) -> DataFrame:
    """One row per row of the Parquet table at ``path``: id, keep_id, group_size, kept, digest.

    Rows whose texts are identical are a group; the one with the greatest id stays, and
    ``keep_id`` is its id. ``state`` is a shared folder for what the queries keep; with the same
    folder a later call takes in the files added since and answers for all of them. By default it
    is a fresh one below ``spark.checkpoint.dir``. Files are taken in ``files_per_batch`` at a
    time, which only bounds what a lost driver has to repeat.

    - Null text: the empty text. Very long texts are hashed and compared whole.
    - Null ids are lowest; ids are integers or texts. Where rows of a group share the
      greatest id, one of them is kept: the one in the last file and row.
    - Empty table: no rows. Other columns are not read, whatever their names.
    """
    state = (state or scratch.scratch_path(spark, "stream-dedup")).rstrip("/")
    table = spark.read.parquet(path)
    kind = table.schema[id_col].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise TypeError(f"ids are integers or texts, not {kind.simpleString()}")
    session = _streaming_session(spark)
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    at = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    source = _source(session, path, table.schema, files_per_batch)
    _run(source.select(digest(body).alias("digest"), F.col(f"`{id_col}`").alias("id"), *at, F.lit(uuid.uuid4().hex).alias("run")), state, "rows", "append")
    written = T.StructType.fromDDL(f"digest string, id {kind.simpleString()}, file string, row long, run string")
    seen = session.readStream.schema(written).option("maxFilesPerTrigger", files_per_batch).parquet(f"{state}/rows")
    _run(_grouped(seen), state, "groups", "update")

    rows = spark.read.schema(written).parquet(f"{state}/rows")
    attached = staged(_attached(rows, _kept(session, spark, state, kind)), "dedup-attached")
    bodies = table.select(at[0].alias("t_file"), at[1].alias("t_row"), body.alias("body"))
    _check(spark, attached, bodies, state)
    refuted = spark.read.schema("digest string, run string").parquet(f"{state}/checked").select("digest").distinct()
    if not refuted.isEmpty():
        attached = _regrouped(attached, refuted, bodies)
    own = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return attached.select(
        F.col("id").alias(id_col), F.when(F.col("keep.has_id"), F.col("keep.id")).alias("keep_id"), F.col("copies").alias("group_size"),
        own.alias("kept"), "digest",
    )


def _streaming_session(spark: SparkSession) -> SparkSession:
    """The caller's settings and a state store on disk, in a session of their own."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    store = "spark.sql.streaming.stateStore"
    session.conf.set(f"{store}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    session.conf.set(f"{store}.rocksdb.maxMemoryUsageMB", "256")
    # Disk is not set aside in advance: four megabytes for each of thousands of partitions.
    session.conf.set(f"{store}.rocksdb.allowFAllocate", "false")
    return session


def _source(session: SparkSession, path: str, schema: T.StructType, files: int) -> DataFrame:
    """The table's files as a stream; a table that is a single file is one of its folder's files."""
    reader = session.readStream.schema(schema).option("maxFilesPerTrigger", files)
    at = session._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at)
    if status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())


def _run(stream: DataFrame, state: str, name: str, mode: str) -> None:
    """Run a streaming query over what there is now; appended rows go to ``state/name``."""
    writer = stream.writeStream.option("checkpointLocation", f"{state}/{name}-progress").outputMode(mode)
    writer = writer.format("parquet").option("path", f"{state}/{name}") if mode == "append" else writer.format("noop")
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _best() -> Column:
    """A row as a value whose greatest is the one that stays: null ids are lowest."""
    return F.struct(F.col("id").isNotNull().alias("has_id"), "id", "file", "row")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max(_best()).alias("keep"), F.min(F.struct("file", "row")).alias("base"), F.count("*").alias("copies"))


def _kept(session: SparkSession, spark: SparkSession, state: str, kind: T.DataType) -> DataFrame:
    """What the state retains: (digest, keep, base, copies)."""
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/groups-progress/state")
    if not files.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(files):
        return spark.createDataFrame([], f"digest string, keep {_KEEP.format(kind.simpleString())}, base struct<file:string,row:long>, copies long")
    held = spark.read.format("statestore").load(f"{state}/groups-progress")
    return held.select("key.digest", F.col("value.max").alias("keep"), F.col("value.min").alias("base"), F.col("value.count").alias("copies"))


def _attached(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with its group.

    Joined by way of the chunks of files that a digest occurs in: a text that fills a third of
    the table has few of them, and no chunk holds more than its rows.
    """
    chunked = rows.withColumn("chunk", F.floor(F.col("row") / _CHUNK))
    chunks = chunked.select(F.col("digest").alias("c_digest"), F.col("file").alias("c_file"), F.col("chunk").alias("c_chunk")).distinct()
    known = chunks.join(groups, F.col("c_digest") == F.col("digest")).select("c_digest", "c_file", "c_chunk", "keep", "base", "copies")
    same = (F.col("digest") == F.col("c_digest")) & (F.col("file") == F.col("c_file")) & (F.col("chunk") == F.col("c_chunk"))
    return chunked.join(known, same).select(*rows.columns, "keep", "base", "copies")


def _check(spark: SparkSession, attached: DataFrame, bodies: DataFrame, state: str) -> None:
    """Compare the texts of hits that no earlier run has compared; digests that differ are written down."""
    root = spark._jvm.org.apache.hadoop.fs.Path(state)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    exists = lambda name: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{name}"))
    runs = [row.run for row in attached.select("run").distinct().collect()]  # one per call that saw new files
    if not runs and not exists("checked"):
        spark.createDataFrame([], "digest string, run string").write.partitionBy("run").parquet(f"{state}/checked")
    for run in runs:
        if exists(f"checked/run={run}/_SUCCESS"):
            continue
        hits = attached.where((F.col("run") == run) & (F.col("copies") > 1))
        wanted = hits.select("digest", "file", "row").union(hits.select("digest", "base.file", "base.row")).distinct()
        lost = F.raise_error(F.concat(F.lit("no text any more at "), "file", F.lit(" row "), F.col("row").cast("string")))
        texts = wanted.join(bodies, (F.col("file") == F.col("t_file")) & (F.col("row") == F.col("t_row")), "left").select(
            "digest", F.coalesce("body", lost.cast("string")).alias("body")
        )
        ends = texts.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
        ends.where("low != high").select("digest").write.mode("overwrite").parquet(f"{state}/checked/run={run}")


def _regrouped(attached: DataFrame, refuted: DataFrame, bodies: DataFrame) -> DataFrame:
    """``attached`` with the rows of refuted digests in groups of equal texts."""
    doubtful = attached.join(refuted, "digest", "left_semi").drop("keep", "base", "copies")
    texts = doubtful.join(bodies, (F.col("file") == F.col("t_file")) & (F.col("row") == F.col("t_row"))).drop("t_file", "t_row")
    exact = texts.groupBy("digest", "body").agg(F.max(_best()).alias("keep"), F.min(F.struct("file", "row")).alias("base"), F.count("*").alias("copies"))
    anew = texts.join(exact, ["digest", "body"]).select(*attached.columns)
    return attached.join(refuted, "digest", "left_anti").select(*attached.columns).union(anew)
