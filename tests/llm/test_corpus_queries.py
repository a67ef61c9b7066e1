import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import _rows, oracle_connection
from tagloom.llm import quality
from tagloom.llm.common import staged
from tagloom.llm.queries import QUERIES, held_out, quality_model
from tagloom.llm.sentencepiece import tokenizer_path
from tagloom.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    pytest.importorskip("duckdb")
    return oracle_connection(SF_DIR)


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    result = oracle.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


def test_toxicity_of_the_table(spark):
    rows = QUERIES["op1_toxicity"](spark, SF_DIR).collect()
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_pieces_of_the_table(spark):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op6_sentencepiece"](spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.covered_bytes) == (len(ids), len(texts[r.doc_id].encode()))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    graded = QUERIES["op7_ordinal_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    good = [r for r in graded if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept == (r.quality == 1) for r in graded) >= 0.93 * len(graded)


#: The base kinds of secrets.
SECRETS = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<assign>[A-Za-z0-9+/_.=-]+)|(?P<access>AKIA[A-Z0-9]+)|(?P<hex>[0-9a-f]{24,})""")


def long_enough(found):
    return any(found[kind] and len(found[kind]) >= least for kind, least in (("assign", 6), ("access", 20), ("hex", 24)))


def windows(text):
    """All 10 consecutive words of letters, digits and what is beyond ASCII; a shorter text is one."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} - {()}


def smallest_of_groups(texts):
    """The smallest id of each group of documents linked by 5-word shingles of a similarity of 0.8 or more."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            group[high] = low
    return {i for i in sets if root(i) == i}


def test_pipeline(spark):
    """Each stage against a brute-force version, on a small table with planted cases that reach their stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    item = items[0]
    good = docs.join(spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1 AND toxic = 0"), "doc_id").where("n_chars > 900 AND lang = 'en'")
    clean, *others = good.orderBy("doc_id").limit(5).collect()
    # Halves of two documents each, so that a case is no near copy of either.
    half = [o.text[: len(o.text) // 2] + " " for o in others] + [" " + o.text[len(o.text) // 2 :] for o in others]
    planted = [
        (10_001, clean.text), (10_002, clean.text + " end"), (10_003, half[0] + item + half[5]),
        (10_004, half[1] + 'password = "hunter22x"' + half[6]), (10_005, None), (10_006, ""), (10_007, half[2] + "AKIA" + "Q7" * 10 + " and " + "0a1b" * 8 + half[7]),
    ]
    extra = spark.createDataFrame([(i, t, "en", "planted", len(t) if t else 0) for i, t in planted], docs.schema)
    now, seen = docs.union(extra), {}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark", "secrets", "encode"]
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, staged(stage(spark, now, SF_DIR), "pipeline-test")
        seen[name] = {r.doc_id: r for r in now.collect()}
        if name != "encode":
            assert now.columns == before.columns
    graded = quality.grade(docs.union(extra), quality_model(docs.union(extra), spark.read.parquet(f"{SF_DIR}/labels.parquet"))).collect()
    assert set(seen["quality"]) == {r.doc_id for r in graded if r.tails[0] >= 0.5}
    assert clean.doc_id in seen["quality"] and {10_001, 10_002, 10_003, 10_004, 10_007} <= set(seen["quality"])
    assert set(seen["near_duplicates"]) == smallest_of_groups({i: r.text for i, r in seen["quality"].items()})
    assert clean.doc_id in seen["near_duplicates"] and not {10_001, 10_002} & set(seen["near_duplicates"])
    assert {10_003, 10_004, 10_007} <= set(seen["near_duplicates"])
    phrases = {window for text in items for window in windows(text)}
    for i, r in seen["near_duplicates"].items():
        after = seen["benchmark"][i]
        if phrases.isdisjoint(windows(r.text or "")):
            assert after.text == r.text
        else:
            assert len(after.text) < len(r.text) and after.n_chars == len(after.text)
    cut = seen["benchmark"][10_003].text
    assert phrases.isdisjoint(windows(cut)) and cut.startswith(half[0].rstrip()[:-20]) and cut.endswith(half[5].lstrip()[20:])
    found = 0
    for i, r in seen["benchmark"].items():
        after, secret = seen["secrets"][i].text or "", [m for m in SECRETS.finditer(r.text or "") if long_enough(m)]
        if not re.search("PRIVATE KEY|eyJ", r.text or ""):  # kinds beyond the base ones
            assert (after == (r.text or "")) == (not secret)
        assert not [m for m in SECRETS.finditer(after) if long_enough(m)]
        found += bool(secret)
    assert found > 1 and "hunter22x" in seen["benchmark"][10_004].text and "hunter22x" not in seen["secrets"][10_004].text
    assert set(seen["encode"]) == set(seen["secrets"]) == set(seen["benchmark"]) == set(seen["near_duplicates"])
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for i, r in seen["encode"].items():
        assert r.ids == library.encode(seen["secrets"][i].text or "") and r.n_tokens == len(r.ids)


def test_pipeline_of_an_empty_table(spark):
    now = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_DIR)
    assert now.collect() == []


def test_held_out_rows_are_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    a = quality_model(docs, labels)
    flipped = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (a.weights == quality_model(docs, flipped).weights).all()
