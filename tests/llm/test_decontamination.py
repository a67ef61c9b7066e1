import random
import re

import numpy as np
import pytest

from tagloom.llm import decontamination as module
from tagloom.llm.decontamination import _item_blocks, contamination, decontaminated
from tagloom.llm.fm_index import FMIndex, suffix_order

DOCS = "doc_id bigint, text string, spans string, items int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, length):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, seen = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    seen |= windows[tuple(w[k : k + n])]
        spans = [k for k in range(len(w) + 1) if (k in hit) != (k - 1 in hit)]
        out.append((i, len(w), spans, sorted(str(s) for s in seen if s is not None)))
    return sorted(out, key=str)


def case():
    rng = random.Random(4)
    small = ["the", "of", "And", "é", "x1", "zu"]
    items = [(i, " ".join(rng.choice(small) for _ in range(rng.randrange(3, 16)))) for i in range(12)] + [(20, "solo"), (21, ""), (22, None), (None, "null item words"), (3, "another text of an item met twice")]
    docs = []
    for i in range(60):
        parts = [rng.choice(small + ["out!", "of...", "vocabulary"]) for _ in range(rng.randrange(120))]
        if i % 4 == 0:
            parts.insert(len(parts) // 2, rng.choice([t for _, t in items if t]))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(70, None), (71, ""), (72, "SOLO?"), (None, "say Null-item, words"), (70, docs[4][1]), (70, docs[4][1])]
    return docs, items


def found(spark, docs, items, **more):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(((r.doc_id, r.n_words, list(r.spans), list(r["items"])) for r in contamination(df, bench, **more).collect()), key=str)


@pytest.mark.parametrize("length", [10, 4])
def test_equals_brute_force(spark, length):
    docs, items = case()
    assert found(spark, docs, items, length=length) == brute(docs, items, length)


def test_blocks_of_the_benchmark_and_small_shards_agree(spark, monkeypatch):
    docs, items = case()
    monkeypatch.setattr(module, "_SHARD", 50)
    assert found(spark, docs, items, length=4, broadcast_bytes=60) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = case()
    assert found(spark, [], items) == []
    assert found(spark, docs[:3], []) == brute(docs[:3], [], 10)


def test_cut(spark):
    docs = [(1, "Keep this. One two, THREE four five! and this", 5), (2, None, None), (3, "nothing", 7), (1, "one two three four five", 5)]
    df = spark.createDataFrame(docs, "doc_id int, text string, spans int")
    bench = spark.createDataFrame([(1, "one two three four five")], "item_id int, text string")
    got = sorted((tuple(r) for r in decontaminated(df, bench).collect()), key=str)
    assert got == sorted([(1, "Keep this. ! and this", 5), (2, None, None), (3, "nothing", 7), (1, "", 5)], key=str)


def test_index_counts_and_places():
    rng = np.random.default_rng(5)
    text = rng.integers(1, 5, 3000)
    text[rng.random(3000) < 0.05] = 0
    text = np.append(text, 0)
    index = FMIndex(text, 5, step=4)
    raw = text.tolist()
    for size in (1, 2, 3, 6):
        patterns = rng.integers(1, 5, (40, size))
        low, high = index.search(patterns, np.full(40, size))
        for row, p in enumerate(patterns.tolist()):
            places = [i for i in range(len(raw) - size + 1) if raw[i : i + size] == p]
            assert high[row] - low[row] == len(places)
            assert sorted(index.locate(np.arange(low[row], high[row])).tolist()) == places


def test_suffix_order_with_long_repeats():
    text = np.array([3, 1, 2] * 70 + [0])
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_blocks_and_a_text_in_a_third_of_the_rows(spark):
    """Several blocks of items give what one gives, also for a row that is repeated many times."""
    items = [(f"i{n}", " ".join(f"w{n}x{k}" for k in range(14))) for n in range(8)] + [(None, "é " * 12), ("short", "only three words")]
    hot = "start " + items[1][1] + " middle " + items[6][1] + " " + items[7][1] + " end"
    rows = [(1, hot)] * 60 + [(i, f"{items[i % 8][1]} and only three words {i}") for i in range(2, 60)] + [(None, None), (70, ""), (71, "é " * 30), (1, "clean")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id string, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    one, many = (sorted((tuple(r) for r in contamination(docs, bench, broadcast_bytes=size).collect()), key=key) for size in (1 << 20, 150))
    assert len(one) == len(rows) and one == many and one[0][3] in (["i1", "i6", "i7"], [])


def test_blocks_are_cut_by_bytes(spark):
    bench = spark.createDataFrame([(str(i), "é" * 50) for i in range(6)], "item_id string, text string").coalesce(1)
    assert [len(b) for b in _item_blocks(bench, "item_id", "text", 200)] == [2, 2, 2]
    assert list(_item_blocks(bench.limit(0), "item_id", "text", 200)) == [] and [len(b) for b in _item_blocks(bench, "item_id", "text", 1)] == [1] * 6
