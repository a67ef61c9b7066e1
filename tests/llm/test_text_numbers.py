import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import common

TEXT = st.text(alphabet="ab é\n\t中", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_split(texts):
    data, at = common.texts_of(pa.array(texts, pa.string()))
    starts, ends, first = common.word_spans(data, at, common.WHITE)
    raw = data.tobytes()
    found = [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert found == [(t or "").encode().split() for t in texts]
    hashes = common.word_hashes(data, starts, ends)
    words = [w for ws in found for w in ws]
    assert len(set(words)) == len(set(hashes.tolist()))
    again = {}
    for word, value in zip(words, hashes.tolist()):
        assert again.setdefault(word, value) == value


def test_rolling_hash_depends_on_the_window_alone():
    values = common.mix(np.arange(2_500_000, dtype=np.uint64) % np.uint64(1000))
    hashes = common.rolling(values, 35)
    assert len(hashes) == len(values) - 34
    assert (hashes[:1000] == hashes[2_000_000:2_001_000]).all() and len(set(hashes[:1000].tolist())) == 1000
    assert len(common.rolling(values[:10], 35)) == 0


def test_blocks_cut_between_texts(monkeypatch):
    monkeypatch.setattr(common, "_BLOCK", 10)
    batch = pa.RecordBatch.from_pydict({"body": ["abc", "", None, "d" * 25, "ef", "gh"]}, pa.schema([("body", pa.string())]))
    got = [(b.num_rows, data.tobytes()) for b, data, _ in common.blocks([batch])]
    assert sum(n for n, _ in got) == 6 and b"".join(d for _, d in got) == b"abc" + b"d" * 25 + b"efgh"
    assert len(got) >= 2


def test_long_words_span_chunks(monkeypatch):
    monkeypatch.setattr(common, "_CHUNK", 64)
    common._powers.cache_clear()
    data = np.frombuffer(b"x" * 500 + b" yy " + b"x" * 500 + b" yy", np.uint8)
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), common.WHITE)
    a, b, c, d = common.word_hashes(data, starts, ends).tolist()
    common._powers.cache_clear()
    assert a == c and b == d and a != b
