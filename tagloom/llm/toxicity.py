"""Toxicity of texts whose insults may be disguised.

A noisy channel: what was meant is a string of letters, written with look-alike digits and
signs, with separators between the letters, or with letters repeated. Stretches of text that
look written so are lattices of what each character may stand for, and Viterbi decoding
under a character trigram model of the corpus restores the likeliest letters. The words of
the restored text are then scored with weights learned from labelled documents.

The character model counts all documents. Word weights come from a bounded sample of
labelled ones.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tagloom.llm.common import (
    blocks,
    drop,
    keyed,
    lowered,
    one_of_each_id,
    staged,
    word_hashes,
    word_spans,
    word_table,
)
from tagloom.llm.shipping import ship

#: Letters that digits and signs are written for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Characters put between the letters of a word.
BETWEEN = " .-_*/\\,~"

_BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of word beginnings: inflected words share them
_CLASSES = 28  # 0 is no letter, 1-26 are a-z, 27 is a byte of a non-ASCII character
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27
_LETTERS = word_table(bytes(range(0x61)) + bytes(range(0x7B, 0x80)))
_SIGNS = np.zeros(256, bool)
_SIGNS[[ord(c) for c in LOOK_ALIKES]] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_INSIDE = _LETTERS | _SIGNS | _DIGITS
_MEANT = np.arange(256, dtype=np.uint8)  # the first letter that a digit or sign is written for
for _char, _letters in LOOK_ALIKES.items():
    _MEANT[ord(_char)] = ord(_letters[0])
_TOKEN = re.compile(rb"[a-z\x80-\xff0-9@$!|+]+")
_SPACED = re.compile(rb"[a-z0-9@$!|](?:[ .\-_*][a-z0-9@$!|](?![a-z0-9\x80-\xff]))+")
#: Single characters with any separators between them; short groups with separators but no spaces between them.
_SPELLED = re.compile(rb"(?<![a-z0-9@$!|+\x80-\xff])[a-z0-9@$!|+](?:[ .\-_*/\\,~]{1,3}[a-z0-9@$!|+](?![a-z0-9@$!|+\x80-\xff])){2,}")
_PARTED = re.compile(rb"(?<![a-z0-9@$!|+\x80-\xff])[a-z0-9@$!|+]{1,4}(?:[.\-_*/\\,~]{1,3}[a-z0-9@$!|+]{1,4}(?![a-z0-9@$!|+\x80-\xff]))+")
_SHORT = 4  # characters of a group that may be part of a word
_EDGE = b"!|+$@"  # signs that may be letters or stand beside a word
_EDGES = {_EDGE[i : i + 1] for i in range(len(_EDGE))}
_WORD = re.compile(rb"[a-z\x80-\xff]+")
_TWO_LETTERS = re.compile(rb"[a-z].*[a-z]", re.S)

# Log-probabilities of the channel.
_AS_IS, _DISGUISED, _DROPPED, _REPEATED = 0.0, math.log(0.2), math.log(0.1), math.log(0.08)
#: Of a sign beside a word that stays one: signs that end sentences or lists, and others.
_MARK, _ODD_MARK, _SAME_MARK = math.log(0.5), math.log(0.002), math.log(0.05)
#: Of a blank between groups of letters that stands within a word.
_JOINED = math.log(0.001)


# --- the character model ---------------------------------------------------------------------


def _trigrams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of (two before, one before, letter class); nothing before a word, or across texts."""
    now = _CLASS[data]
    one, two = np.zeros_like(now), np.zeros_like(now)
    one[1:], two[2:] = now[:-1], now[:-2]
    starts = at[:-1][at[:-1] < len(data)]
    one[starts] = 0
    after = starts + 1
    two[after[after < len(data)]] = 0
    two[one == 0] = 0
    return np.bincount((two * _CLASSES + one) * _CLASSES + now, minlength=_CLASSES**3)


_COUNTS = pa.schema([("gram", pa.int32()), ("c", pa.int64())])


def _count_trigrams(batches):
    total = np.zeros(_CLASSES**3, np.int64)
    for _, data, at in blocks(batches):
        total += _trigrams(lowered(data), at)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], schema=_COUNTS)


class CharacterModel:
    """Log-probability of a letter after two others, mixed with shorter contexts."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + _CLASSES)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
        self.table = np.log(p3)
        self.log = self.table.tolist()
        same = np.array([p2[c, c] for c in range(_CLASSES)])
        #: Letters that are hardly ever doubled.
        self.rare_double = same < 0.004
        self.rare_double[[0, 27]] = False


def character_model(docs: DataFrame, text_col: str = "text") -> CharacterModel:
    """Trigram counts of all texts: each task sends at most one row per trigram of classes."""
    texts = keyed(docs, text_col, text_col).select("body")
    rows = texts.mapInArrow(_count_trigrams, "gram int, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    counts = np.zeros(_CLASSES**3, np.int64)
    for row in rows.toLocalIterator():  # 28**3 rows at most
        counts[row.gram] = row.c
    return CharacterModel(counts)


# --- decoding --------------------------------------------------------------------------------


def viterbi(token: bytes, model: CharacterModel, edges: str = "both", parted: bool = False, join: bool = False) -> bytes:
    """The likeliest letters behind a disguised stretch (in lower case); spaces stay where words end.

    Signs at its ends are letters, or stay as they are (``edges``: both, letters or signs).
    Separators are dropped or become spaces; where they are ``parted`` groups of letters, not
    single ones, they are dropped or stay as they are. With ``join`` all are dropped. Steps point
    back to the one before, so that a long stretch costs no more a byte than a short one; of
    readings that are as likely the greatest text is taken.
    """
    log = model.log
    lead = len(token) - len(token.lstrip(_EDGE))
    trail = len(token.rstrip(_EDGE))
    # State: the last two restored classes and the last source byte; value: score and last step.
    states: dict[tuple[int, int, int], tuple[float, _Step]] = {(0, 0, 0): (0.0, None)}
    for i, byte in enumerate(token):
        char = chr(byte)
        edge = i < lead or i >= trail
        options: list[tuple[int | None, float]] = []
        if byte >= 128 or "a" <= char <= "z":
            options.append((byte, _AS_IS))
        elif char in LOOK_ALIKES and not (edge and edges == "signs"):
            options += [(ord(letter), _DISGUISED) for letter in LOOK_ALIKES[char]]
        if char in BETWEEN:
            if join:
                options.append((None, _DROPPED))
            else:
                options += [(None, _JOINED if byte == 32 else _DROPPED), (byte, _AS_IS)] if parted else [(None, _DROPPED / 4), (32, _DROPPED * 2)]
        if edge and edges != "letters":
            options.append((byte, _ODD_MARK if char in "$@" or (char == "!" and i < lead) else _MARK))
        after: dict[tuple[int, int, int], tuple[float, _Step]] = {}
        for (two, one, source), (score, text) in states.items():
            for letter, cost in options:
                if letter is None:
                    found = (two, one, 0), score + cost, text
                elif edge and letter == byte:
                    # A sign beside a word: it ends the word before, if there is one.
                    again = not one and source == byte
                    found = (0, 0, byte), score + (max(cost, _SAME_MARK) if again else cost) + (log[two][one][0] if one else 0.0), (text, byte)
                else:
                    c = int(_CLASS[letter])
                    key = (one if c else 0, c, byte)
                    found = key, score + cost + log[two if one else 0][one][c], (text, letter)
                if found[0] not in after or after[found[0]][0] < found[1]:
                    after[found[0]] = found[1:]
            # Signs at an end are doubled letters rather than repeated ones.
            if source == byte and char not in BETWEEN and not (edge and (edges == "letters" or not one)):
                key, cost = (two, one, byte), _REPEATED * (2 if edge else 1)
                if key not in after or after[key][0] < score + cost:
                    after[key] = score + cost, text
        states = after or states
    ends = [
        (score + (0.0 if text and text[1] in _EDGE else log[two if one else 0][one][0]), text)
        for (two, one, _), (score, text) in states.items()
    ]
    best = max(score for score, _ in ends)
    return max(_restored(text) for score, text in ends if score == best)


#: The step before and the byte restored in this one; None before the first.
_Step = tuple | None


def _restored(step: _Step) -> bytes:
    out = bytearray()
    while step:
        step, byte = step
        out.append(byte)
    return bytes(out[::-1])


def _suspects(data: np.ndarray, at: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Places in disguised stretches: signs beside letters, repeated letters, single letters in a row."""
    n = len(data)
    letter, sign, digit = _LETTERS[data], _SIGNS[data], _DIGITS[data]
    found = np.zeros(n, bool)
    linked = _linked(n, at)
    found[:-1] |= sign[:-1] & letter[1:] & linked
    found[1:] |= letter[:-1] & (digit | sign)[1:] & linked
    same = np.zeros(n, bool)
    ascii_letter = letter & (data < 128)
    same[:-1] = (data[:-1] == data[1:]) & ascii_letter[:-1] & linked
    found[:-1] |= same[:-1] & (same[1:] | rare[data[:-1]])
    alone = letter | digit | sign
    inside = letter | digit
    alone[1:] &= ~(inside[:-1] & linked)
    alone[:-1] &= ~(inside[1:] & linked)
    if n > 4:
        found[:-4] |= alone[:-4] & alone[2:-2] & alone[4:] & ~inside[1:-3] & ~inside[3:-1]
    return np.flatnonzero(found)


def _linked(n: int, at: np.ndarray) -> np.ndarray:
    """Whether each byte but the last is followed by one of the same text."""
    linked = np.ones(max(n - 1, 0), bool)
    firsts = at[(at > 0) & (at < n)]
    linked[firsts - 1] = False
    return linked


def _joinable(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of short words with single spaces between them that make a likelier word together.

    A space is judged by the trigrams around it, joined against split; each word has a letter.
    """
    starts, ends, first = word_spans(data, at, _INSIDE)
    if len(starts) < 2:
        return []
    sizes = ends - starts
    left, right = starts[:-1], starts[1:]
    pair = (right - ends[:-1] == 1) & (data[ends[:-1] % len(data)] == 32)
    pair &= (sizes[:-1] <= _SHORT) & (sizes[1:] <= _SHORT) & (sizes[:-1] + sizes[1:] >= 3)
    letters = np.concatenate(([0], np.cumsum(_LETTERS[data])))
    worded = letters[ends] > letters[starts]
    pair &= worded[:-1] & worded[1:]
    pair &= data[ends[:-1] - 1] != ord("!")  # it ends a sentence there
    heads = first[1:-1]
    pair[heads[(heads > 0) & (heads < len(starts))] - 1] = False  # words of two texts
    at_ = np.flatnonzero(pair)
    classes = _CLASS[_MEANT[data]]
    left, right, stop = left[at_], right[at_], ends[1:][at_]
    a = classes[ends[:-1][at_] - 1]
    b = np.where(sizes[at_] > 1, classes[np.maximum(ends[:-1][at_] - 2, 0)], 0)
    c = classes[right]
    d = np.where(sizes[1:][at_] > 1, classes[np.minimum(right + 1, len(data) - 1)], 0)
    gain = table[b, a, c] + table[a, c, d] - table[b, a, 0] - table[0, 0, c] - table[0, c, d]
    good = (gain + _JOINED > 0) & (a > 0) & (c > 0)
    out: list[tuple[int, int]] = []
    for start, end in zip(left[good].tolist(), stop[good].tolist(), strict=True):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


@dataclass
class Restorer:
    model: CharacterModel
    known: dict[tuple[bytes, bool], tuple[bytes, tuple[bytes, ...]]] = field(default_factory=dict)

    def _readings(self, token: bytes, parted: bool) -> tuple[bytes, tuple[bytes, ...]]:
        """The best reading of a stretch, and the words of it and other readings that are not written there.

        Where signs at the ends may be letters or not, and separators parts of a word or not, the
        trigrams cannot always tell: the words of either reading count.
        """
        got = self.known.get((token, parted))
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            best = viterbi(token, self.model, parted=parted)
            readings = [best]
            edges = ("letters", "signs") if token[:1] in _EDGES or token[-1:] in _EDGES else ("both",)
            if len(edges) > 1 or parted:
                readings += [viterbi(token, self.model, edge, parted, join) for edge in edges for join in ((False, True) if parted else (False,))]
            written = set(_WORD.findall(token))
            words = _WORD.findall(best)
            for other in readings[1:]:
                words += set(_WORD.findall(other)).difference(words)
            got = self.known[token, parted] = best, tuple(w for w in words if w not in written)
        return got

    def _candidates(self, data: np.ndarray, at: np.ndarray, raw: bytes) -> list[tuple[int, int, bool]]:
        """(start, end, parted) of stretches with separators in them, without overlaps."""
        spans = [(start, end, True) for start, end in _joinable(data, at, self.model.table)]
        for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            text = raw[low:high]
            for pattern, parted in ((_SPELLED, False), (_PARTED, True)):
                for match in pattern.finditer(text):
                    if _TWO_LETTERS.search(match[0]) and match.end() - match.start() > 3:
                        spans.append((low + match.start(), low + match.end(), parted))
        spans.sort(key=lambda s: (s[0], -s[1], s[2]))
        out: list[tuple[int, int, bool]] = []
        for start, end, parted in spans:
            if out and start < out[-1][1]:
                # Stretches that meet are one; it is parted unless one of single letters is all of it.
                if end > out[-1][1]:
                    out[-1] = out[-1][0], end, True
            else:
                out.append((start, end, parted))
        return out

    def _found(self, data: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, bytes, tuple[bytes, ...]]]:
        """(text, start, end, restored, words to add) of each stretch that may be disguised."""
        if not len(data):
            return []
        rare = np.zeros(256, bool)
        rare[97:123] = self.model.rare_double[1:27]
        raw = data.tobytes()
        spans = self._candidates(data, at, raw)
        firsts = np.array([s[0] for s in spans], np.int64)
        lasts = np.array([s[1] for s in spans], np.int64)
        places = _suspects(data, at, rare)
        if len(spans):
            around = np.searchsorted(firsts, places, "right") - 1
            places = places[(around < 0) | (places >= lasts[around])]
        places = np.concatenate((places, firsts))
        numbers = np.concatenate((np.full(len(places) - len(spans), -1), np.arange(len(spans))))
        order = np.argsort(places, kind="stable")
        places, numbers = places[order], numbers[order]
        rows = np.searchsorted(at, places, "right") - 1
        out, done, next_ = [], 0, 0
        for place, row, number in zip(places.tolist(), rows.tolist(), numbers.tolist(), strict=True):
            low, high = int(at[row]), int(at[row + 1])
            parted = False
            if number >= 0:
                start, end, parted = spans[number]
                next_ = number + 1
            else:
                if place < done:
                    continue
                high = min(high, spans[next_][0]) if next_ < len(spans) else high
                start = place
                while start > max(low, done) and _TOKEN.match(raw, start - 1, start):
                    start -= 1
                spaced = _SPACED.match(raw, place, high)
                plain = _TOKEN.match(raw, start, high)
                if spaced and spaced.end() - place >= 5 and (not plain or plain.end() - start <= 2):
                    start, end = place, spaced.end()
                else:
                    end = plain.end()
            done = end
            token = raw[start:end]
            if not token.strip(_EDGE):
                continue
            restored, words = self._readings(token, parted)
            out.append((row, start, end, restored, words))
        return out

    def stretches(self, data: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, bytes]]:
        """(text, start, end, restored) of each disguised stretch; ``data`` is in lower case.

        Stretches likeliest read as they are written are none; signs at an end that are not
        letters are outside.
        """
        return self._disguised(data, self._found(data, at))

    def _disguised(self, data: np.ndarray, found: list) -> list[tuple[int, int, int, bytes]]:
        out = []
        for row, start, end, restored, _ in found:
            if restored == data[start:end].tobytes():
                continue
            core = restored.strip(_EDGE)
            before = len(restored) - len(restored.lstrip(_EDGE))
            out.append((row, start + before, end - (len(restored) - before - len(core)), core))
        return out

    def features(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash) of each word and word beginning of the restored texts, and the stretches restored per text.

        The words of a disguised stretch as written stay in: bits of words that mean nothing to
        the weights.
        """
        data = lowered(data)
        rows, hashes = _features(data, at)
        found = self._found(data, at)
        counts = np.bincount(np.array([r[0] for r in self._disguised(data, found)], np.int64), minlength=len(at) - 1)
        found = [r for r in found if r[4]]
        if found:
            texts = [b" ".join(r[4]) for r in found]
            bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            owner = np.array([r[0] for r in found], np.int64)
            more, extra = _features(np.frombuffer(b"".join(texts), np.uint8), bounds)
            rows, hashes = np.concatenate((rows, owner[more])), np.concatenate((hashes, extra))
        return rows, hashes, counts


def _features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each word, and of its first bytes where it is longer."""
    starts, ends, first = word_spans(data, at, _LETTERS)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
    rows, hashes = [owner], [word_hashes(data, starts, ends)]
    for size in _BEGINNINGS:
        longer = ends - starts > size
        rows.append(owner[longer])
        hashes.append(word_hashes(data, starts[longer], starts[longer] + size) ^ np.uint64(size))
    return np.concatenate(rows), np.concatenate(hashes)


# --- weights ---------------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    characters: CharacterModel
    hashes: np.ndarray  # of telling words and beginnings, sorted
    weights: np.ndarray
    bias: float

    def counts(self, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, count) of the telling features of texts."""
        if not len(self.hashes):
            none = np.zeros(0, np.int64)
            return none, none, none
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[place] == hashes)
        pairs, counts = np.unique(rows[hit] * len(self.hashes) + place[hit], return_counts=True)
        return pairs // len(self.hashes), pairs % len(self.hashes), counts

    def scores(self, rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        texts, features, counts = self.counts(rows, hashes)
        total = self.bias + np.bincount(texts, weights=self.weights[features] * np.log1p(counts), minlength=n)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    def learn(self, labels: np.ndarray, texts: np.ndarray, features: np.ndarray, counts: np.ndarray, steps: int = 400, decay: float = 1e-4) -> None:
        """Logistic regression on the logarithms of the counts (all of the sample in each step).

        Toxic examples are the few: each counts as the root of the ratio of clean to toxic ones.
        """
        n, m = len(labels), len(self.hashes)
        worth = np.where(labels > 0, math.sqrt(max(1.0, (labels == 0).sum() / max(1, (labels > 0).sum()))), 1.0) / n
        value = np.log1p(counts)
        weights, bias = np.zeros(m), self.bias
        first, second = np.zeros(m + 1), np.zeros(m + 1)
        for step in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(texts, weights=weights[features] * value, minlength=n), -40, 40)))
            gap = (p - labels) * worth
            slope = np.append(np.bincount(features, weights=gap[texts] * value, minlength=m) + decay * weights, gap.sum())
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope**2
            move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            weights, bias = weights - move[:-1], bias - move[-1]
        self.weights, self.bias = weights, float(bias)


_WORDS = pa.schema([("word", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])


def _count_words(characters: CharacterModel):
    def run(batches):
        restorer = Restorer(characters)
        for batch, data, at in blocks(batches):
            rows, hashes, _ = restorer.features(data, at)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = np.unique(np.stack((rows.astype(np.uint64), hashes), 1), axis=0)
            words, inverse = np.unique(pairs[:, 1], return_inverse=True)
            bad = np.bincount(inverse, weights=toxic[pairs[:, 0].astype(np.int64)], minlength=len(words)).astype(np.int64)
            all_ = np.bincount(inverse, minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(bad), pa.array(all_ - bad)], schema=_WORDS)

    return run


_HITS = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def _find_features(model: ToxicityModel):
    def run(batches):
        restorer = Restorer(model.characters)
        for batch, data, at in blocks(batches):
            n = len(at) - 1
            rows, hashes, _ = restorer.features(data, at)
            texts, features, counts = model.counts(rows, hashes)
            offsets = pa.array(np.searchsorted(texts, np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(features.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))],
                schema=_HITS,
            )

    return run


def _evidence(toxic: str, clean: str, n_toxic: int, n_clean: int) -> Column:
    """Log-likelihood ratio (G) of a word's counts among toxic and clean documents."""
    share = n_toxic / (n_toxic + n_clean)
    a, b = F.col(toxic), F.col(clean)

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(F.lit(0.0))

    return 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = 20_000, words: int = 20_000, least_evidence: float = 20.0,
) -> ToxicityModel:
    """Learn the model: characters from all of ``docs``, weights from labelled ones.

    ``labels`` holds id and label (1 toxic, 0 not; other values and nulls are passed over);
    ``usable`` says which of its rows may be learned from. Of these, the ``sample_rows`` with the
    smallest hash of their id are used: their ids are broadcast, and their counts of telling
    words reach the driver. Of an id with several rows the text with the smallest hash is used,
    once; an id without a row counts for nothing. A word or word beginning is telling if its evidence is at least
    ``least_evidence``; at most ``words`` of them make the model. Without toxic or without clean
    examples none has a weight.
    """
    characters = character_model(docs, text_col)
    marked = labels.where(usable & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("k_id")).agg(F.max(label_col).alias("toxic"))
    sample = marked.orderBy(F.xxhash64("k_id"), "k_id").limit(sample_rows)
    texts = keyed(docs, id_col, text_col)
    learned = staged(one_of_each_id(texts.join(F.broadcast(sample), "k_id"), "toxic").select("body", "toxic"), "toxicity-sample")
    try:
        return _fitted(characters, learned, words, least_evidence)
    finally:
        drop(learned)


def _fitted(characters: CharacterModel, learned: DataFrame, words: int, least_evidence: float) -> ToxicityModel:
    """The model of labelled texts (body, toxic)."""
    counts = {int(r.toxic): r["count"] for r in learned.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    bias = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    none = ToxicityModel(characters, np.zeros(0, np.uint64), np.zeros(0), min(bias, -1.0))
    if not n_toxic or not n_clean:
        return none
    counted = learned.mapInArrow(_count_words(characters), "word long, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    share = n_toxic / (n_toxic + n_clean)
    strong = counted.where((F.col("toxic") >= 3) & (F.col("toxic") > (F.col("toxic") + F.col("clean")) * share))
    strong = strong.withColumn("g", _evidence("toxic", "clean", n_toxic, n_clean)).where(F.col("g") >= least_evidence)
    rows = strong.orderBy(F.desc("g"), "word").limit(words).collect()
    if not rows:
        return none
    model = ToxicityModel(characters, np.sort(np.array([r.word for r in rows], np.int64).view(np.uint64)), np.zeros(0), bias)
    hits = learned.mapInArrow(_find_features(model), "toxic int, features array<int>, counts array<int>").toPandas()
    sizes = hits["features"].map(len).to_numpy()
    order = np.lexsort((sizes, hits["toxic"].to_numpy()))  # sums in one order, whichever task came first
    hits, sizes = hits.iloc[order], sizes[order]
    model.learn(
        hits["toxic"].to_numpy().astype(float), np.repeat(np.arange(len(hits)), sizes),
        np.concatenate([*hits["features"], np.zeros(0, np.int32)]).astype(np.int64), np.concatenate([*hits["counts"], np.zeros(0, np.int32)]),
    )
    return model


# --- over tables -----------------------------------------------------------------------------


def _score_rows(model: ToxicityModel, schema: pa.Schema):
    def run(batches):
        restorer = Restorer(model.characters)
        for batch, data, at in blocks(batches):
            rows, hashes, restored = restorer.features(data, at)
            scores = model.scores(rows, hashes, len(at) - 1)
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "body"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array(restored.astype(np.int32))], schema=schema)

    return run


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1), restored (how many stretches were disguised).

    Null and empty texts have the score of a text without telling words. Equal rows have equal
    scores; null ids are carried along; an empty table gives no rows; other columns, labels
    among them, are not read.
    """
    texts = keyed(docs, id_col, text_col).select("k_id", "body")
    out = StructType([texts.schema["k_id"], StructField("score", DoubleType()), StructField("restored", IntegerType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    return texts.mapInArrow(_score_rows(model, arrow), out).withColumnRenamed("k_id", id_col)


def _restore_rows(model: CharacterModel, schema: pa.Schema):
    def run(batches):
        restorer = Restorer(model)
        for batch, data, at in blocks(batches):
            raw = data.tobytes()
            cuts: dict[int, list] = {}
            for row, start, end, text in restorer.stretches(lowered(data), at):
                cuts.setdefault(row, []).append((start, end, text))
            texts = []
            for row in range(len(at) - 1):
                place, parts = int(at[row]), []
                for start, end, text in cuts.get(row, ()):
                    parts += [raw[place:start], text]
                    place = end
                texts.append(b"".join([*parts, raw[place : int(at[row + 1])]]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("k_id"), pa.array(texts, pa.string())], schema=schema)

    return run


def restore(docs: DataFrame, model: CharacterModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, restored text (disguised stretches decoded, all else as it is)."""
    ship(docs.sparkSession)
    texts = keyed(docs, id_col, text_col).select("k_id", "body")
    out = StructType([texts.schema["k_id"], StructField("restored", StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    return texts.mapInArrow(_restore_rows(model, arrow), out).withColumnRenamed("k_id", id_col)
