import gzip
import hashlib
import os
from types import SimpleNamespace

from tagloom.llm import warc
from tagloom.llm.warc import payload_digest, read_warc, write_warc

DDL = "page_id bigint, url string, html string, path string"
PAGES = [
    (5, "http://a/1", "<p>same</p>", "clash"), (3, "http://a/2", "<p>same</p>", None), (9, None, "<p>same</p>", None),
    (1, "http://b", None, None), (2, "http://c", "", None), (7, "http://d é\n", "é" * 40_000, None),
    (None, "http://e", "<p>same</p>", None), (8, "http://f", "\x1f\x8b\x08 WARC/1.1 " * 3, None), (3, "http://a/2", "<p>same</p>", None),
]


def run(spark, folder, pages=PAGES, **more):
    files = write_warc(spark.createDataFrame(pages, DDL).repartition(2), folder + "/w", **more)
    return files, read_warc


def test_round_trip(spark, folder):
    files, _ = run(spark, folder)
    rows = read_warc(files).collect()
    assert all(r.intact for r in rows)
    got = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows)
    expected = []
    for page_id, _, html, _ in PAGES:
        body = (html or "").encode()
        first = min(p for p, _, h, _ in PAGES if p is not None and (h or "") == (html or ""))
        again = page_id != first
        name = f"urn:pages:{'' if page_id is None else page_id}"
        expected.append((name, "revisit" if again else "response", f"urn:pages:{first}" if again else None, len(body), payload_digest(body)))
    assert got == sorted(expected)
    bodies = {r.record_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert bodies["urn:pages:7"] == ("é" * 40_000).encode() and bodies["urn:pages:8"].startswith(b"\x1f\xc2\x8b\x08")


def test_any_split_finds_each_record_once(spark, folder):
    pages = [(i, "http://x", os.urandom(700).hex(), None) for i in range(60)]
    files, _ = run(spark, folder, pages, file_bytes=20_000)
    assert files.count() > 1
    for split in (97, 1_000, 7_919, 1 << 20):
        rows = read_warc(files, split_bytes=split, payloads=False).collect()
        assert sorted(int(r.record_id.rsplit(":", 1)[1]) for r in rows) == list(range(60)), split


def test_members_are_ordinary_gzip(spark, folder):
    files, _ = run(spark, folder)
    text = b"".join(gzip.open(r.path).read() for r in files.collect())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)
    assert b"WARC-Target-URI: http://d%20" in text


def test_least_revisit_and_empty_table(spark, folder):
    files, _ = run(spark, folder, least_revisit=1)
    kinds = {r.record_id: r.record_type for r in read_warc(files).collect()}
    assert kinds["urn:pages:1"] == kinds["urn:pages:2"] == "response" and kinds["urn:pages:5"] == "revisit"
    assert read_warc(write_warc(spark.createDataFrame([], DDL), folder + "/none")).collect() == []


def test_digest():
    assert payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(payload_digest(hashlib.sha1(b"x").digest())) == 32


def foreign(folder, *records, cut=0):
    """An archive of another writer, as a manifest."""
    path = f"{folder}/foreign.warc.gz"
    data = b"".join(gzip.compress(r) for r in records)
    with open(path, "wb") as out:
        out.write(data[: len(data) - cut])
    return path, len(data) - cut


def head(*lines, block=b""):
    return b"WARC/1.0\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody\r\n\r\nmore"
FOREIGN = [
    head(b"WARC-Type: warcinfo", b"Content-Type: application/warc-fields", b"Content-Length: 16", block=b"a: b\r\n\r\nc: defgh"),
    head(b"WARC-Type: request", b"WARC-Record-ID: <urn:1>", b"Content-Type: application/http; msgtype=request", b"Content-Length: 18", block=b"GET / HTTP/1.0\r\n\r\n"),
    head(b"WARC-Type: response", b"WARC-Record-ID: <urn:2>", b"WARC-Target-URI: <http://x>", b"Content-Type: application/http", b"Content-Length: %d" % len(HTTP), block=HTTP),
    head(b"WARC-Record-ID: urn:3", block=b"no type, no length"),
    head(b"WARC-Type: metadata", b"Content-Length: 99", b"WARC-Payload-Digest: md5:abc", block=b"too short"),
    head(b"WARC-Type: resource", b"Content-Length: 4", b"WARC-Payload-Digest: md5:abc", block=b"\x00\xff\r\n"),
    head(b"WARC-Type: resource", b"Content-Length: x", b"WARC-Payload-Digest: sha1:WRONG", block=b"odd"),
]


def test_archives_of_other_writers(spark, folder):
    path, size = foreign(folder, *FOREIGN)
    files = spark.createDataFrame([(path, size)], "path string, bytes long")
    for split in (50, 1 << 20):
        got = [(r.record_type, r.record_id, r.url, bytes(r.payload), r.intact) for r in read_warc(files, split_bytes=split).orderBy("place").collect()]
        assert got == [
            ("warcinfo", None, None, b"a: b\r\n\r\nc: defgh", True), ("request", "urn:1", None, b"", True), ("response", "urn:2", "http://x", b"body\r\n\r\nmore", True),
            ("unknown", "urn:3", None, b"no type, no length", True), ("metadata", None, None, b"too short\r\n\r\n", False),
            ("resource", None, None, b"\x00\xff\r\n", True), ("resource", None, None, b"odd", False),
        ]


def test_member_cut_off_at_the_end_is_no_record(spark, folder):
    path, size = foreign(folder, *FOREIGN[:3], cut=9)
    files = spark.createDataFrame([(path, size)], "path string, bytes long")
    assert [r.record_type for r in read_warc(files, split_bytes=64).orderBy("place").collect()] == ["warcinfo", "request"]


def test_record_far_longer_than_a_range(spark, folder):
    text = os.urandom(12 << 20).hex()
    files, _ = run(spark, folder, [(1, "http://x", text, None), (2, "http://y", "short", None), (3, "http://z", text, None)])
    rows = {r.record_id: r for r in read_warc(files, split_bytes=1 << 20, payloads=False).collect()}
    assert rows["urn:pages:1"].payload_bytes == rows["urn:pages:3"].payload_bytes == 24 << 20 and len(rows) == 3
    assert rows["urn:pages:1"].payload_digest == payload_digest(text.encode())


def test_ranges_are_dealt_to_as_many_tasks(spark, folder):
    files, _ = run(spark, folder, [(i, "http://x", os.urandom(700).hex(), None) for i in range(60)])
    assert read_warc(files, split_bytes=1_000).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    total = files.agg({"bytes": "sum"}).first()[0]
    assert read_warc(files, split_bytes=100, task_bytes=200).rdd.getNumPartitions() == -(-total // 200)
    assert read_warc(files).rdd.getNumPartitions() == files.count()


def test_stores_by_their_names(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(warc, "fs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=asked.append), LocalFileSystem=lambda: "disk"))
    for uri in ("s3a://b/a.gz", "s3n://b/a.gz", "s3://b/a.gz", "hdfs://n/a.gz"):
        warc._store(uri)
    assert asked == ["s3://b/a.gz", "s3://b/a.gz", "s3://b/a.gz", "hdfs://n/a.gz"]
    assert warc._store("file:/x/y") == warc._store("/x/y") == ("disk", "/x/y")
    assert warc._qualified(spark, "/x/y") == "/x/y"
