"""WARC archives: one gzip member per record, written and read by Spark tasks.

Payloads that occur again become ``revisit`` records without the payload. Reading splits the
archives into byte ranges. A task looks for gzip magic in its range, takes a place as the
start of a record only if the member there decodes and opens with a WARC header, and owns
every record that starts inside its range; the last one may end beyond it.

Files are opened through Arrow's file systems, so archives can be wherever a URI leads
(``file:``, ``hdfs:``, ``s3:`` or ``s3a:``, ``gs:``); a path without a scheme is one of the
cluster's default file system, as it is to Spark.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import scratch
from tagloom.llm.common import staged
from tagloom.llm.shipping import ship

#: Fixed values of the format.
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"  # the tables hold no crawl time, and archives are to be reproducible

_HEAD = 1 << 16  # bytes decoded to tell a record from chance magic


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        parts = urlparse(uri)
        if parts.scheme == "file":
            return fs.LocalFileSystem(), parts.path
        # Hadoop's names of the same store
        return fs.FileSystem.from_uri("s3" + uri[3:] if parts.scheme in ("s3a", "s3n") else uri)
    return fs.LocalFileSystem(), uri


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI every executor reads alike; as it is if it is on the local disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()
    return folder if whole.startswith("file:") else whole


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, name: str, url: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    lines = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{refers}>"]
    return _VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(text: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in text)


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


# --- writing ---------------------------------------------------------------------------------

_FILES = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]):
        store, root = _store(folder)
        path, out, size, records = "", None, 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("name", "url", "body", "digest", "refers")]
            for row in zip(*columns, strict=True):
                name, url, body, digest, refers = (x.as_py() for x in row)
                if out is None:
                    # A name of its own for every attempt: what a lost task left is in no manifest.
                    name_of_file = f"part-{uuid.uuid4().hex}.warc.gz"
                    path = f"{folder}/{name_of_file}"
                    out, size, records = store.open_output_stream(f"{root}/{name_of_file}", compression=None), 0, 0
                member = _member(_record("revisit" if refers else "response", name, url or "", body or b"", digest, refers))
                out.write(member)
                size += len(member)
                records += 1
                if size >= file_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": records}], _FILES)
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": records}], _FILES)

    return run


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", space: str = "pages",
    least_revisit: int = 0, file_bytes: int = 256 << 20,
) -> DataFrame:
    """Write one record per row; returns the manifest (path, bytes, records) of files to read.

    Of the rows with an equal payload (UTF-8 of the text, '' for null) of at least
    ``least_revisit`` bytes, those with the smallest id are ``response`` records and all others
    ``revisit`` ones that refer to it. Ids are in the record names, ``urn:{space}:{id}``.

    - Null ids have the name ``urn:{space}:`` and are responses only where a payload has no
      other id. Rows that repeat the smallest id are all responses. Null urls are empty.
    - An empty table writes nothing. Other columns are not read.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = _qualified(spark, folder.rstrip("/"))
    _make(folder)
    body = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), body.alias("body")).withColumn("sha1", F.sha1("body"))
    # Smallest id per payload, combined before the shuffle; only payloads that occur again are kept.
    firsts = staged(
        rows.where(F.octet_length("body") >= least_revisit).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1").select("sha1", "first"),
        "warc-firsts",
    )
    name = F.concat(F.lit(f"urn:{space}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.concat(F.lit(f"urn:{space}:"), F.col("first").cast("string")))
    told = rows.join(firsts, "sha1", "left").select(name.alias("name"), "url", "body", F.col("sha1"), refers.alias("refers"))
    return staged(
        told.select("name", "url", "body", _base32("sha1").alias("digest"), "refers").mapInArrow(_write(folder, file_bytes), "path string, bytes long, records long"),
        "warc-manifest",
    )


def _base32(sha1: str) -> Column:
    """Upper-case base 32 of 160 bits in hex: five hex digits make four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for i in range(0, 40, 5):
        value = F.conv(F.substring(sha1, i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(letters, F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


def _make(folder: str) -> None:
    store, root = _store(folder)
    store.create_dir(root, recursive=True)


# --- reading ---------------------------------------------------------------------------------


class _Window:
    """Bytes of a file from a place on, read ahead in steps."""

    def __init__(self, file, at: int, step: int = 1 << 20):
        self.file, self.at, self.data, self.step = file, at, bytearray(), step
        file.seek(at)

    def more(self) -> bool:
        got = self.file.read(self.step)
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.at += n
        del self.data[:n]


def _records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the records whose member starts in [start, end)."""
    window = _Window(file, start)
    known = False  # whether the place ahead is the end of a record
    while True:
        if not known:
            place = _find(window, end)
            if place is None:
                return
        if window.at >= end:
            return
        record = _decode(window)
        if record is None:
            if not window.data and not window.more():
                return
            window.drop(1)
            known = False
            continue
        place, record = record
        known = True
        yield place, record


def _find(window: _Window, end: int) -> int | None:
    """Move to the next gzip magic before ``end``."""
    while True:
        at = window.data.find(_MAGIC)
        if at >= 0:
            window.drop(at)
            return window.at if window.at < end else None
        window.drop(max(0, len(window.data) - 2))
        if window.at >= end or not window.more():
            return None


def _decode(window: _Window) -> tuple[int, bytes] | None:
    """The record of the member ahead, or None if what is there is no record."""
    while len(window.data) < 3 and window.more():
        pass
    if window.data[:3] != _MAGIC:
        return None
    place, unpack, out, used = window.at, zlib.decompressobj(31), io.BytesIO(), 0
    try:
        while not unpack.eof:
            part = bytes(window.data[used : used + _HEAD])
            if not part:
                if not window.more():
                    return None
                continue
            out.write(unpack.decompress(part))
            used += len(part)
            if used <= _HEAD and out.tell() >= 5 and not out.getbuffer()[:5].tobytes() == b"WARC/":
                return None
    except zlib.error:
        return None
    record = out.getvalue()
    if not record.startswith(b"WARC/"):
        return None
    window.drop(used - len(unpack.unused_data))
    return place, record


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").strip().lower()] = value.decode(errors="replace").strip()
    return out


_RECORDS = pa.schema([
    ("path", pa.string()), ("place", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_()),
])


def _parsed(path: str, place: int, record: bytes, keep: bool) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    length = _number(fields.get("content-length"))
    block = rest.removesuffix(b"\r\n\r\n") if length is None else rest[:length]
    whole = length is None or len(block) == length
    http, payload = b"", block
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    told = fields.get("warc-payload-digest")
    told = told.removeprefix("sha1:") if told is not None else None
    kind = fields.get("warc-type", "unknown")
    size, digest, intact = len(payload), told, whole
    if kind == "revisit":
        size = _number(_headers(http).get("content-length")) or 0
    else:
        digest = payload_digest(payload)
        # other algorithms' digests cannot be compared
        intact = whole and (told is None or ":" in told or digest == told)
    return {
        "path": path, "place": place, "record_type": kind, "record_id": _bare(fields.get("warc-record-id")),
        "url": _bare(fields.get("warc-target-uri")), "payload_bytes": size, "payload_digest": digest,
        "refers_to": _bare(fields.get("warc-refers-to")), "payload": payload if keep and kind != "revisit" else None, "intact": intact,
    }


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.isdecimal() else None


def _bare(name: str | None) -> str | None:
    return name.strip("<>") if name is not None else None


def _read(keep: bool):
    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                store, name = _store(path)
                with store.open_input_file(name) as file:
                    for place, record in _records_in(file, start, end):
                        rows.append(_parsed(path, place, record, keep))
                        held += len(record) if keep else 500
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return run


def read_warc(files: DataFrame, split_bytes: int = 8 << 20, payloads: bool = True, task_bytes: int = 128 << 20) -> DataFrame:
    """The records of the archives in ``files`` (path, bytes), read in byte ranges.

    Ranges of ``split_bytes`` are dealt to one task for each ``task_bytes`` of all archives, and
    to no fewer than keep the cluster busy.

    Returns path, place (of the member in the file), record_type, record_id, url,
    payload_bytes, payload_digest, refers_to, payload (null for revisits, or unless
    ``payloads``) and intact. Size and digest are those of the full payload: computed for
    responses, as told by the record for revisits; ``intact`` is whether the record's digest
    agrees. Where a range starts makes no difference to the records found.

    Archives of others: the payload of an ``application/http`` record is what follows the HTTP
    header, of any other record its whole block. Without a content length the block is the
    rest of the member; without a type a record is ``unknown``; a record without a digest, or
    with one of another algorithm, is intact if it has its length. What a member cut off at
    the end of a file holds is no record. A record is held whole in its task, however long.
    """
    spark = files.sparkSession
    ship(spark)
    sizes = files.agg(F.sum("bytes"), F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / split_bytes))).first()
    # Ranges are few short rows: their own size says nothing about the work.
    tasks = max(1, min(sizes[1] or 1, max(-(-(sizes[0] or 0) // task_bytes), 4 * spark.sparkContext.defaultParallelism)))
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0).cast("long")), F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "bytes", start.alias("start")).select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    dealt = ranges.repartition(tasks, F.col("path"), F.col("start"))
    return dealt.mapInArrow(
        _read(payloads),
        "path string, place long, record_type string, record_id string, url string, payload_bytes long, payload_digest string, "
        "refers_to string, payload binary, intact boolean",
    )


def archive_folder(spark: SparkSession) -> str:
    return scratch.scratch_path(spark, "warc")
