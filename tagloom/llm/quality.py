"""Quality grades of texts by ordinal (cumulative-link) regression.

Ratings are grades 0 to K-1. One set of weights over hashed text features moves a text along
a line, and K-1 ordered thresholds cut the line into grades: the probability of a grade of k
or more is the logistic of the distance to threshold k. That gives tail probabilities for
selecting and their sum, the expected grade, for ranking.

Features are shares of hashed byte trigrams, and of hashed word shapes (beginning, ending,
length, case, repetition of the word before), both as square roots, so that each group has
length 1 whatever the length of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tagloom.llm.common import (
    WHITE,
    blocks,
    keyed,
    mix,
    one_of_each_id,
    word_hashes,
    word_spans,
)
from tagloom.llm.shipping import ship

_TRIGRAMS, _SHAPES = 3072, 1024
WIDTH = _TRIGRAMS + _SHAPES

#: Kind of each byte in a word's shape: lower case, upper case, digit, sign, non-ASCII.
_KIND = np.full(256, 3, np.uint64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``WIDTH`` numbers per text."""
    n = len(at) - 1
    out = np.zeros((n, WIDTH), np.float32)
    wide = data.astype(np.uint64)
    trigrams = np.zeros(len(data), np.int64)
    if len(data) > 2:
        code = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)
        trigrams[:-2] = (mix(code) % np.uint64(_TRIGRAMS)).astype(np.int64)
    starts, ends, first = word_spans(data, at, WHITE)
    if len(starts):
        words = word_hashes(data, starts, ends)
        size = np.minimum(ends - starts, 15).astype(np.uint64)
        again = np.zeros(len(words), np.uint64)
        again[1:] = words[1:] == words[:-1]
        # Words before the first one of a text are another text's.
        again[first[:-1][first[:-1] < len(words)]] = 0
        last, before = data[ends - 1], data[np.maximum(ends - 2, starts)]
        sign = _KIND[last] == 3
        code = (
            _KIND[data[starts]] | _KIND[before] << np.uint64(3) | np.where(sign, last, 0).astype(np.uint64) << np.uint64(6)
            | again << np.uint64(14) | (size // np.uint64(3)) << np.uint64(15) | _KIND[last] << np.uint64(20)
        )
        shapes = (mix(code) % np.uint64(_SHAPES)).astype(np.int64)
    for row in range(n):
        low, high = int(at[row]), int(at[row + 1]) - 2
        if high > low:
            out[row, :_TRIGRAMS] = np.sqrt(np.bincount(trigrams[low:high], minlength=_TRIGRAMS) / (high - low))
        low, high = int(first[row]), int(first[row + 1])
        if high > low:
            out[row, _TRIGRAMS:] = np.sqrt(np.bincount(shapes[low:high], minlength=_SHAPES) / (high - low))
    return out


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def tails(self, x: np.ndarray) -> np.ndarray:
        """Probability of a grade of at least 1, 2, ... for each row."""
        line = x @ self.weights
        return 1 / (1 + np.exp(-np.clip(line[:, None] - self.thresholds[None, :], -40, 40)))


def learn(x: np.ndarray, grades: np.ndarray, n_grades: int, epochs: int = 60, decay: float = 2e-4, batch: int = 256, seed: int = 7) -> OrdinalModel:
    """Fit by the likelihood of the grades, with adaptive steps over shuffled batches.

    Thresholds stay ordered: each is the one before plus the exponential of a free number.
    """
    n, width = x.shape
    share = np.array([(grades >= k).mean() for k in range(1, n_grades)])
    start = -np.log(np.clip(share, 0.01, 0.99) / (1 - np.clip(share, 0.01, 0.99)))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.05))))
    theta = np.concatenate((np.zeros(width), free))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for rows in np.array_split(order.permutation(n), max(1, n // batch)):
            step += 1
            part, got = x[rows], grades[rows]
            cuts = _cuts(theta[width:])
            line = part @ theta[:width].astype(np.float32)
            # P(grade = k) = F(cut k+1 - line) - F(cut k - line), with cuts 0 and K at the ends.
            edges = np.concatenate(([-np.inf], cuts, [np.inf]))
            high, low = _logistic(edges[got + 1] - line), _logistic(edges[got] - line)
            p = np.maximum(high - low, 1e-9)
            slope_high, slope_low = high * (1 - high) / p, low * (1 - low) / p
            d_line = (slope_high - slope_low) / len(rows)
            d_cuts = np.zeros(len(cuts) + 2)
            np.add.at(d_cuts, got + 1, -slope_high / len(rows))
            np.add.at(d_cuts, got, slope_low / len(rows))
            d_cuts = d_cuts[1:-1]
            later = np.cumsum(d_cuts[::-1])[::-1]  # a free number moves its threshold and all above
            d_free = later * np.concatenate(([1.0], np.exp(theta[width + 1 :])))
            slope = np.concatenate((part.T @ d_line.astype(np.float32) + decay * theta[:width], d_free))
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(theta[:width].astype(np.float32), _cuts(theta[width:]))


def _cuts(free: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


_EXAMPLES = pa.schema([("place", pa.int64()), ("grade", pa.int32()), ("x", pa.binary())])


def _example_rows(batches):
    for batch, data, at in blocks(batches):
        x = features(data, at).astype(np.float16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("grade"), pa.array([row.tobytes() for row in x], pa.binary())], schema=_EXAMPLES
        )


def fit(
    docs: DataFrame, ratings: DataFrame, grade: Column, n_grades: int, usable: Column, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = 4000,
) -> OrdinalModel:
    """Learn from rated documents: ``ratings`` holds ids and what ``grade`` (0 to n_grades - 1) is made of.

    ``usable`` says which of its rows may be learned from; rows without id or grade are passed
    over, repeated ids have their highest grade. The ``sample_rows`` with the smallest hash of
    their id are used: their ids are broadcast, their features (8 KB each) reach the driver. Of
    an id with several rows the text with the smallest hash is used, once.
    Without two different grades every text has the only grade there is (or 0).
    """
    rated = ratings.where(usable).select(F.col(id_col).alias("k_id"), grade.cast("int").alias("grade")).where("k_id IS NOT NULL")
    rated = rated.where(F.col("grade").between(0, n_grades - 1)).groupBy("k_id").agg(F.max("grade").alias("grade"))
    place = F.xxhash64("k_id")
    sample = rated.orderBy(place, "k_id").limit(sample_rows).withColumn("place", place)
    texts = one_of_each_id(keyed(docs, id_col, text_col).join(F.broadcast(sample), "k_id"), "place", "grade").select("place", "grade", "body")
    rows = texts.mapInArrow(_example_rows, "place long, grade int, x binary").toPandas()
    rows = rows.sort_values(["place", "grade", "x"])  # the same order, whichever task came first
    grades = rows["grade"].to_numpy().astype(np.int64)
    if len(set(grades.tolist())) < 2:
        only = int(grades[0]) if len(grades) else 0
        return OrdinalModel(np.zeros(WIDTH, np.float32), np.where(np.arange(1, n_grades) <= only, -40.0, 40.0))
    x = np.frombuffer(b"".join(rows.pop("x")), np.float16).reshape(len(grades), WIDTH).astype(np.float32)
    return learn(x, grades, n_grades)


def _grade_rows(model: OrdinalModel, text_at: int, schema: pa.Schema):
    def run(batches):
        for whole in batches:
            named = pa.RecordBatch.from_arrays(whole.columns, [str(i) for i in range(whole.num_columns)])
            for batch, data, at in blocks([named], str(text_at)):
                tails = model.tails(features(data, at))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, tails.size + 1, tails.shape[1], dtype=np.int32)), pa.array(tails.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(axis=1)), lists], schema=schema)

    return run


def grade(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade, and tails: the probabilities of a grade of at least 1, 2, ...

    Null and empty texts are graded by the thresholds alone. All columns are kept; columns of
    ``docs`` with one of the new names are replaced. Equal texts have equal grades; an empty
    table gives no rows.
    """
    ship(docs.sparkSession)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("expected_grade", "tails")))
    out = StructType([*kept.schema.fields, StructField("expected_grade", DoubleType()), StructField("tails", ArrayType(DoubleType()))])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    return kept.mapInArrow(_grade_rows(model, kept.columns.index(text_col), arrow), out)
