import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm.sentencepiece import Model, encode, load, model_bytes, tokenizer_path

library = pytest.importorskip("sentencepiece")
PATH = tokenizer_path("piece_bpe_32k.model")
MODEL, LIBRARY = load(PATH), library.SentencePieceProcessor(model_file=PATH)
ALPHABET = list("ab \n\tthe▁éß中👍\x00!?'\"01.,-ﬁ　") + ["the ", "ing", "  ", "▁", "Hello"]


def checked(text):
    ids, begins, ends = MODEL.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids.tolist())
    data = text.encode()
    # spans follow each other and cover the text; each is what its piece stands for
    assert [0, *ends.tolist()] == [*begins.tolist(), len(data)]
    for i, low, high in zip(ids.tolist(), begins.tolist(), ends.tolist()):
        piece, source = MODEL.surface[i], data[low:high].replace("▁".encode(), b" ")
        assert piece == source or (low == 0 and piece == b" " + source)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join))
def test_equals_the_library(text):
    checked(text)


@pytest.mark.parametrize("text", ["", " ", "  ", "\n", "a", "x" * 300, "   leading", "a▁b", "<s> </s> <unk> <0x0A>", "é́", "word " * 200])
def test_edges_equal_the_library(text):
    checked(text)


def field(number, wire, value):
    head = bytes([number << 3 | wire])
    return head + (bytes([len(value)]) + value if wire == 2 else value)


def small_model(charsmap=b"", **flags):
    pieces = [("<unk>", 0.0, 2), ("▁", -5.0, 1), ("a", -6.0, 1), ("b", -7.0, 1), ("ab", -1.0, 1), ("▁ab", -2.0, 1), ("f", -8.0, 1), ("i", -9.0, 1), ("fi", -3.0, 1)]
    data = b"".join(
        field(1, 2, field(1, 2, n.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for n, s, k in pieces
    )
    data += field(2, 2, field(3, 0, b"\x02"))
    spec = (b"\x12" + bytes([len(charsmap) & 127 | 128, len(charsmap) >> 7]) + charsmap if charsmap else b"") + b"".join(
        field(n, 0, bytes([v])) for n, v in flags.values()
    )
    return Model(data + b"\x1a" + bytes([len(spec) & 127 | 128, len(spec) >> 7]) + spec)


def trie(word, value):
    """A double array with the one key ``word``, laid out by hand: a unit per byte, then its leaf."""
    units, node = [0] * 1024, 0
    units[0] = 256 << 10  # children of the root begin at 256
    base = 256
    for i, byte in enumerate(word):
        node = base ^ byte
        nxt = 256 * (i + 2) if i < 2 else 256
        last = i == len(word) - 1
        offset = node ^ (512 if i % 2 == 0 else 768)
        units[node] = (offset << 10) | byte | (256 if last else 0)
        base = node ^ offset
        del nxt
    units[base] = value | 1 << 31
    return struct.pack("<I", len(units) * 4) + struct.pack(f"<{len(units)}I", *units)


def test_longest_prefix_in_the_compiled_map_keeps_the_source_span():
    # the ligature of three bytes becomes two letters, both from its place
    model = small_model(trie("ﬁ".encode(), 0) + b"fi\x00", squeeze=(4, 0))
    assert model.map.longest("ﬁ".encode(), 0) == (b"fi", 3) and model.map.longest(b"fi", 0) is None
    ids, begins, ends = model.encode("aﬁb")
    assert [model.names[i] for i in ids] == ["▁", "a", "fi", "b"]
    assert list(zip(begins.tolist(), ends.tolist())) == [(0, 0), (0, 1), (1, 4), (4, 5)]


def test_squeezed_spaces():
    model = small_model(squeeze=(4, 1))
    ids, begins, ends = model.encode("  ab   ab ")
    assert [model.names[i] for i in ids] == ["▁ab", "▁ab"]
    assert ends.tolist()[-1] >= 9 and begins.tolist()[0] == 2 and model.decode(ids) == "ab ab"
    assert model.encode("   ")[0].tolist() == []


def test_rows_nulls_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, None, None), (3, "", "z"), (None, "a " * 5000, "w"), (1, "Hello world", "x")], "doc_id int, text string, ids string")
    out = encode(df, model_bytes(PATH), decoded=True)
    assert out.columns == ["doc_id", "text", "ids", "begins", "ends", "decoded"]
    rows = out.collect()
    assert [(r.doc_id, r.ids) for r in rows] == [(d, LIBRARY.encode(t or "")) for d, t in ((1, "Hello world"), (2, ""), (3, ""), (None, "a " * 5000), (1, "Hello world"))]
    assert [r.decoded for r in rows] == ["Hello world", "", "", "a " * 5000, "Hello world"]
    assert encode(df.limit(0), model_bytes(PATH)).collect() == []
