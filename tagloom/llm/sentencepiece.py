"""SentencePiece encoding and decoding of BPE models, with the source bytes of every piece.

A text is normalised by longest-prefix matches in the model's compiled character map (a
double-array trie over bytes), noting for each byte it makes where in the source it came
from. Pieces are then merged by score, and projecting their places back through the notes
gives each piece its byte span in the text as it was.

Merging works on stretches that no piece can cross. Where the vocabulary has no piece with
a space inside or at the end, a stretch is a word with the spaces before it, and words that
come again are looked up.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tagloom.llm.shipping import ship

#: Fixed values of the format: piece types, the space mark, the sign for unknown pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "

_NEVER = 1 << 30  # order of pairs that do not merge
_WORDS_KEPT = 1_000_000  # words looked up again; a full table starts anew


# --- the model file --------------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""

    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = varint(at)
        elif wire == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[wire]
            value, at = data[at : at + size], at + size
        yield number, value


class CharacterMap:
    """Longest-prefix replacement of byte strings by a compiled character map."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest prefix of ``data[at:]`` in the map."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._onward(0, units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node = self._onward(node, unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, length = found
        return self.texts[start : self.texts.index(0, start)], length

    @staticmethod
    def _onward(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))


class Model:
    """A BPE model of the library's file format."""

    def __init__(self, data: bytes):
        self.names: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.dummy_prefix = self.squeeze = self.escape = True
        self.suffix_space = self.byte_fallback = False
        charsmap, model_type, self.unknown_surface = b"", 1, UNKNOWN_SURFACE
        for number, value in _fields(data):
            if number == 1:
                name, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        name = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.names.append(name)
                scores.append(score)
                self.kinds.append(kind)
            elif number == 2:
                for n, v in _fields(value):
                    if n == 3:
                        model_type = v
                    elif n == 24:
                        self.suffix_space = bool(v)
                    elif n == 35:
                        self.byte_fallback = bool(v)
                    elif n == 44:
                        self.unknown_surface = v.decode()
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2:
                        charsmap = v
                    elif n == 3:
                        self.dummy_prefix = bool(v)
                    elif n == 4:
                        self.squeeze = bool(v)
                    elif n == 5:
                        self.escape = bool(v)
        if model_type != 2:
            raise ValueError("only BPE models are supported")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.map = CharacterMap(charsmap)
        self.unknown = self.kinds.index(UNKNOWN)
        self.ids = {name: i for i, name in enumerate(self.names) if self.kinds[i] == NORMAL}
        #: Order of merging: a smaller number goes first, equal scores share one.
        steps = {score: n for n, score in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.order = {name: steps[scores[i]] for name, i in self.ids.items() if len(name) > 1}
        self.bytes = [0] * 256
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.bytes[int(self.names[i][3:5], 16)] = i
        self.mark = SPACE if self.escape else " "
        self.plain = not charsmap and not self.squeeze and self.dummy_prefix and self.escape and not self.suffix_space
        # Words can be merged on their own if no piece goes on after its space marks with another.
        self.by_word = all(SPACE not in name.lstrip(SPACE) for name in self.ids)
        self.by_line = all("\n" not in name for name in self.ids)
        surface = [self._surface(i) for i in range(len(self.names))]
        self.surface = surface
        # Source bytes of a piece of an unchanged text, where a space mark is one byte.
        self.width = np.array([1 if kind == BYTE else len(s) for kind, s in zip(self.kinds, surface, strict=True)], np.int64)
        self.words: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def _surface(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.names[i][3:5], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return self.unknown_surface.encode()
        return self.names[i].replace(SPACE, " ").encode()

    # --- normalising

    def normalised(self, data: bytes) -> tuple[bytes, list[int]]:
        """The text as it is split, and for each of its bytes (and its end) the source byte."""
        mark = self.mark.encode()
        out, source = bytearray(), []
        at, end = 0, len(data)

        def prefix(at):
            found = self.map.longest(data, at)
            if found is not None:
                return found
            size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            return data[at : at + size], size

        if self.squeeze:
            while at < end:
                text, size = prefix(at)
                if text != b" ":
                    break
                at += size
        if at == end:
            return b"", [at]

        def put(text, place):
            for byte in text:
                if byte == 0x20 and self.escape:
                    out.extend(mark)
                    source.extend([place] * len(mark))
                else:
                    out.append(byte)
                    source.append(place)

        if self.dummy_prefix and not self.suffix_space:
            put(b" ", at)
        after_space = self.squeeze
        while at < end:
            text, size = prefix(at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                # A character keeps its bytes apart if it is unchanged, so bytes have spans too.
                if text == data[at : at + size] and text != b" ":
                    out.extend(text)
                    source.extend(range(at, at + size))
                else:
                    put(text, at)
                after_space = text.endswith(b" ")
            at += size
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                at = source[len(out)]
                del source[len(out) :]
        if self.dummy_prefix and self.suffix_space:
            put(b" ", at)
        source.append(at)
        return bytes(out), source

    # --- merging

    def merged(self, text: str) -> list[str]:
        """The pieces of a stretch of normalised text."""
        order, parts, far = self.order, list(text), _NEVER
        if len(parts) > 40:
            return self._merged_long(parts)
        ranks = [order.get(a + b, far) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == far:
                break
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = order.get(parts[i] + parts[i + 1], far)
            if i:
                ranks[i - 1] = order.get(parts[i - 1] + parts[i], far)
        return parts

    def _merged_long(self, parts: list[str]) -> list[str]:
        """The same with a queue of pairs, for stretches of any length."""
        order, n = self.order, len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[int, int, int]] = []

        def offer(i, j):
            if i >= 0 and j >= 0:
                rank = order.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, len(parts[i]) + len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            rank, i, size = heapq.heappop(queue)
            j = right[i]
            if not parts[i] or j < 0 or len(parts[i]) + len(parts[j]) != size:
                continue
            if order.get(parts[i] + parts[j]) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p]

    def numbers(self, text: str) -> list[int]:
        """Ids of a stretch of normalised text."""
        parts, ids = self.merged(text), self.ids
        out = [ids.get(piece, -1) for piece in parts]
        if -1 not in out:
            return out
        out = []
        for piece in parts:
            i = ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return out

    def stretch(self, word: str, known: dict[str, bytes], mark: str) -> bytes:
        if len(known) >= _WORDS_KEPT:
            known.clear()
        out = array("i", self.numbers(mark + word)).tobytes()
        if len(word) <= 64:
            known[word] = out
        return out

    # --- encoding

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and first and end source byte of each piece."""
        if not text:
            empty = np.zeros(0, np.int32)
            return empty, empty, empty
        if self.plain and self.by_word and self.by_line and SPACE not in text and "  " not in text and text[0] != " ":
            ids = self._encode_words(text)
            ends = np.cumsum(self.width[ids])
            # The space before the text is not in it: the first piece begins a byte late.
            ends -= 1
            begins = np.empty_like(ends)
            begins[0], begins[1:] = 0, ends[:-1]
            return ids, begins.astype(np.int32), ends.astype(np.int32)
        return self._encode_aligned(text)

    def _encode_words(self, text: str) -> np.ndarray:
        words, heads = self.words, self.heads
        parts = []
        for n, line in enumerate(text.split("\n")):
            items = line.split(" ")
            if n:
                parts.append(self._newline())
                # No space is before the first word of a line; a line may begin with one, too.
                head = items[0]
                if head:
                    parts.append(heads.get(head) or self.stretch(head, heads, ""))
                items = items[1:]
            for word in items:
                parts.append(words.get(word) or self.stretch(word, words, SPACE))
        return np.frombuffer(b"".join(parts), np.int32)

    def _newline(self) -> bytes:
        return self.heads.get("\n") or self.stretch("\n", self.heads, "")

    def _encode_aligned(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, source = self.normalised(text.encode())
        norm = data.decode("utf-8", "replace")
        stretches = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", norm) if self.by_word and self.escape else [norm]
        ids, widths = [], []
        for stretch in stretches:
            for piece in self.merged(stretch):
                i, size = self.ids.get(piece), len(piece.encode())
                if i is not None:
                    ids.append(i)
                    widths.append(size)
                elif self.byte_fallback:
                    ids.extend(self.bytes[b] for b in piece.encode())
                    widths.extend([1] * size)
                else:
                    # Unknown pieces that follow each other are one.
                    if ids and ids[-1] == self.unknown:
                        widths[-1] += size
                    else:
                        ids.append(self.unknown)
                        widths.append(size)
        ends = np.cumsum(np.array(widths, np.int64))
        source = np.array(source, np.int64)
        stops = source[ends] if len(ends) else ends
        begins = np.concatenate(([source[0]], stops[:-1])) if len(ends) else ends
        return np.array(ids, np.int32), begins.astype(np.int32), stops.astype(np.int32)

    # --- decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: space marks become spaces, bytes characters again."""
        data = b"".join(map(self.surface.__getitem__, ids.tolist()))
        if (self.dummy_prefix or self.squeeze) and data[:1] == b" ":
            first = next(i for i in ids.tolist() if self.surface[i])
            if self.kinds[first] == NORMAL:
                data = data.lstrip(b" ") if self.squeeze else data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return "".join(_lossy(data))


def _lossy(data: bytes) -> Iterator[str]:
    """Characters, each byte that belongs to none replaced."""
    at = 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                yield data[at : at + size].decode()
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


@lru_cache(maxsize=2)
def _loaded(data: bytes) -> Model:
    return Model(data)


def load(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


# --- over tables -----------------------------------------------------------------------------

_STEP = 256  # rows returned at a time


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _encode_rows(model: bytes, text_at: int, decode: bool, schema: pa.Schema):
    def run(batches):
        encoder = _loaded(model)
        for whole in batches:
            low = 0
            while low < whole.num_rows:
                high, size = low, 0
                texts = []
                while high < whole.num_rows and high - low < _STEP and size < 4 << 20:
                    texts.append(whole.column(text_at)[high].as_py() or "")
                    size += len(texts[-1])
                    high += 1
                done = [encoder.encode(text) for text in texts]
                columns = [*whole.slice(low, high - low).columns, *(_lists([d[i] for d in done]) for i in range(3))]
                if decode:
                    columns.append(pa.array([encoder.decode(d[0]) for d in done], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                low = high

    return run


def encode(docs: DataFrame, model: bytes, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with the columns ids, begins, ends (and decoded): pieces and their source bytes.

    Ids are those of the library's ``encode`` without begin and end; ``begins`` and ``ends`` are
    byte places in the text as it is. A piece that stands for no byte of it (the space put
    before a text) has an empty span. ``decoded`` is the text that the ids stand for.

    Null and empty texts have no pieces. All columns are kept; columns of ``docs`` with one of
    the new names are replaced. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    new = ["ids", "begins", "ends"] + (["decoded"] if decoded else [])
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in new or c == text_col))
    if text_col in new:
        raise ValueError(f"the text column cannot be named {text_col}")
    numbers = ArrayType(IntegerType())
    out = StructType([*kept.schema.fields, *(StructField(c, numbers) for c in new[:3]), *([StructField("decoded", StringType())] if decoded else [])])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    return kept.mapInArrow(_encode_rows(model, kept.columns.index(text_col), decoded, arrow), out)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file of the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
