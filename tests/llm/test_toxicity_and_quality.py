import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import quality, toxicity

DDL = "doc_id bigint, text string, toxic int, score double"
BAD = ["idiot", "moron", "worthlez", "scumbag"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    syllables = ["ta", "ri", "mon", "se", "lu", "den", "wor", "id", "sco", "les", "umb", "ag"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 60))]
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), 9, 0.5))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DDL)
    marks = spark.createDataFrame(labels + [(None, 1), (3, None), (4, 7)], "doc_id bigint, toxic int")
    return toxicity.fit(docs, marks, F.col("doc_id") % 3 != 1)


def test_held_out_and_disguised(spark, model):
    rows, labels = corpus()
    toxic = dict(labels)
    scores = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, DDL), model).collect()}
    held = [i for i in scores if i % 3 == 1]
    assert all((scores[i] >= 0.7) == bool(toxic[i]) for i in held)
    plain = "ta ri mon se lu den ta ri "
    texts = [plain + t for t in ("1d10t m0r0n", "i d i o t and m o r o n", "idiiiiot mooooron", "scumb@g w0rthlez", "I.D.I.O.T. MORON")]
    df = spark.createDataFrame([(i, t, 0, 0.0) for i, t in enumerate(texts)] + [(90, plain, 0, 0.0), (91, None, 0, 0.0), (92, "", 0, 0.0), (None, plain, 0, 0.0), (0, texts[0], 0, 0.0)], DDL)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(texts) + 5
    for r in got:
        assert (r.score >= 0.7) == (r.doc_id is not None and r.doc_id < 90), r
        assert 0 <= r.score <= 1


def paths(token):
    """All readings of a token as its lattice allows them, with their cost."""
    out = [(0.0, b"", 0)]
    for byte in token:
        char, after = chr(byte), []
        for cost, text, source in out:
            if "a" <= char <= "z":
                after.append((cost, text + char.encode(), byte))
            for letter in toxicity.LOOK_ALIKES.get(char, ""):
                after.append((cost + toxicity._DISGUISED, text + letter.encode(), byte))
            if char in toxicity.BETWEEN:
                after += [(cost + toxicity._DROPPED / 4, text, 0), (cost + toxicity._DROPPED * 2, text + b" ", byte)]
            elif source == byte:
                after.append((cost + toxicity._REPEATED, text, byte))
        out = after
    return out


@pytest.mark.parametrize("token", [b"1d10t", b"i d i o t", b"idiiiot", b"m0.r0n", b"aa11", b"s-c u"])
def test_viterbi_finds_the_best_of_all_readings(model, token):
    log = model.characters.log

    def score(cost, text):
        one = two = 0
        for byte in text + b" ":
            c = int(toxicity._CLASS[byte])
            cost += log[two if one else 0][one][c]
            two, one = (one, c) if c else (0, 0)
        return cost

    best = max(score(cost, text) for cost, text, _ in paths(token))
    got = toxicity.viterbi(token, model.characters)
    assert max(score(cost, text) for cost, text, _ in paths(token) if text == got) == pytest.approx(best)


def test_restored_text(spark, model):
    df = spark.createDataFrame([(1, "You 1d10t! And THE rest $5."), (2, None), (3, "mmoooron é")], "doc_id int, text string")
    got = {r.doc_id: r.restored for r in toxicity.restore(df, model.characters).collect()}
    assert got[1].startswith("You idiot! And THE rest") and got[2] == "" and got[3] == "moron é"


def test_without_examples(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id int, toxic int"), F.lit(True))
    assert toxicity.score(docs, none).first().score < 0.5
    assert toxicity.score(docs.limit(0), none).collect() == []


def test_ordinal_fit_recovers_order_and_tails():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (3000, 12)).astype(np.float32)
    line = x @ rng.normal(0, 1.5, 12) + rng.logistic(0, 1, 3000)
    grades = np.digitize(line, [-2.0, 0.0, 2.5])
    fitted = quality.learn(x[:2000], grades[:2000], 4)
    assert (np.diff(fitted.thresholds) > 0).all()
    tails = fitted.tails(x[2000:])
    assert (np.diff(tails, axis=1) <= 1e-9).all()
    expected = tails.sum(axis=1)
    assert np.corrcoef(expected, grades[2000:])[0, 1] > 0.8
    for k in (1, 2, 3):
        assert abs(tails[:, k - 1].mean() - (grades[2000:] >= k).mean()) < 0.05


def test_grades_of_texts(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    good = [" ".join(word() for _ in range(40)) for _ in range(150)]
    shout = [" ".join(word().upper() + "!!" for _ in range(40)) for _ in range(150)]
    again = [" ".join([word()] * 20 + [word()] * 20) for _ in range(150)]
    rows = [(i, t, 0.0) for i, t in enumerate(good + shout + again)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, expected_grade double")
    ratings = spark.createDataFrame([(i, 2 if i < 150 else 0 if i < 300 else 1) for i in range(450)] + [(None, 1), (3, None), (4, 9)], "doc_id bigint, rating int")
    fitted = quality.fit(docs, ratings, F.col("rating"), 3, F.col("doc_id") % 2 == 0)
    got = {r.doc_id: r for r in quality.grade(docs, fitted).where("doc_id % 2 = 1").collect()}
    assert np.mean([(r.tails[0] >= 0.5) == (i < 150 or i >= 300) for i, r in got.items()]) > 0.97
    assert np.mean([(r.tails[1] >= 0.5) == (i < 150) for i, r in got.items()]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (3, "ab " * 100_000)], "doc_id int, text string")
    assert quality.grade(odd, fitted).count() == 4 and quality.grade(odd.limit(0), fitted).collect() == []
    one = quality.fit(docs, ratings.where("rating = 1"), F.col("rating"), 3, F.lit(True))
    assert quality.grade(odd, one).first().expected_grade == pytest.approx(1, abs=1e-6)


EDGE_OR_PARTED = [
    (b"!diot", b"idiot"), (b"$cumbag", b"scumbag"), (b"scumba9", b"scumbag"), (b"!d!ot!", b"idiot"), (b"mo.ron", b"moron"), (b"id-iot", b"idiot"),
    (b"i  d  i  o  t", b"idiot"), (b"i/d/i/o/t", b"idiot"), (b"m0.r0n", b"moron"), (b"mo ron", b"moron"), (b"m oron", b"moron"),
]


@pytest.mark.parametrize("written, meant", EDGE_OR_PARTED)
def test_signs_at_the_ends_and_parted_words_form_one_stretch(model, written, meant):
    text = b"tariden " + written + b" seluden"
    found = toxicity.Restorer(model.characters).stretches(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [r[3] for r in found] == [meant], found


def test_disguises_at_the_ends_and_parted_words_are_scored(spark, model):
    plain = "tariden seluden "
    df = spark.createDataFrame([(i, plain + (w.decode() + " ") * 4) for i, (w, _) in enumerate(EDGE_OR_PARTED)] + [(99, plain * 3)], "doc_id int, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert [i for i, score in sorted(scores.items()) if (score >= 0.7) != (i < 99)] == [], sorted(scores.items())


def test_trailing_signs_that_are_letters():
    rows = ["an ass is a dumbass and a class pass mass "] * 20
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    at = np.arange(0, len(data) + 1, len(rows[0]))
    restorer = toxicity.Restorer(toxicity.CharacterModel(toxicity._trigrams(data, at)))
    for written, meant in ((b"a$$", b"ass"), (b"dumb@$$", b"dumbass"), (b"dumb@$$!", b"dumbass"), (b"@ss", b"ass")):
        assert [r[3] for r in restorer.stretches(np.frombuffer(written, np.uint8), np.array([0, len(written)]))] == [meant]
    # A sign that is not a letter stays, and neighbours in a batch make no stretch.
    text = b"pass!$5"
    assert restorer.stretches(np.frombuffer(text, np.uint8), np.array([0, 5, 7])) == []


def test_repeated_ids_are_learned_from_once(spark, monkeypatch):
    """Rows that repeat ids change no model, and at most one row per sampled id is learned from."""
    rows, labels = corpus(150)
    docs = spark.createDataFrame(rows, DDL)
    again = docs.union(spark.createDataFrame([rows[0]] * 300 + [rows[1]] * 200, DDL)).repartition(8)
    marks = spark.createDataFrame(labels + [(10_000 + i, 0) for i in range(100)], "doc_id bigint, toxic int")
    seen = []
    learn = quality.learn
    monkeypatch.setattr(quality, "learn", lambda x, grades, n: seen.append(len(x)) or learn(x, grades, n, epochs=2))
    once, more = (quality.fit(d, marks, F.col("toxic"), 2, F.lit(True)) for d in (docs, again))
    assert seen == [150, 150] and (once.weights == more.weights).all()
    characters = toxicity.character_model(docs)
    monkeypatch.setattr(toxicity, "character_model", lambda *_: characters)
    once, more = (toxicity.fit(d, marks, F.lit(True)) for d in (docs, again))
    assert len(once.hashes) and (once.hashes == more.hashes).all() and once.bias == pytest.approx(more.bias)
    assert once.weights == pytest.approx(more.weights)
    # Ids without a document are no examples.
    alone = toxicity.fit(docs, marks.where("doc_id < 10000"), F.lit(True))
    assert (alone.hashes == once.hashes).all() and alone.bias == pytest.approx(once.bias)


def test_ordinal_fit_is_a_minimum_of_the_likelihood():
    """The likelihood as a direct sum over examples: slopes by finite differences vanish, and any step away is worse."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 3)).astype(np.float32)
    grades = np.digitize(x @ np.array([1.0, -0.7, 0.3]) + rng.logistic(0, 1, 400), [-1.0, 0.8])
    decay = 1e-3

    def loss(theta):
        cuts = [theta[3], theta[3] + np.exp(theta[4])]
        total = 0.0
        for row, grade in zip(x.astype(float), grades):
            reach = [1.0] + [1 / (1 + np.exp(c - row @ theta[:3])) for c in cuts] + [0.0]
            total -= np.log(reach[grade] - reach[grade + 1])
        return total / len(x) + decay / 2 * theta[:3] @ theta[:3]

    fitted = quality.learn(x, grades, 3, epochs=400, decay=decay, batch=400)
    low, high = fitted.thresholds
    theta = np.concatenate((fitted.weights.astype(float), [low, np.log(high - low)]))
    here, start = loss(theta), loss(np.zeros(5))
    steps = np.eye(5) * 1e-4
    slopes = [(loss(theta + s) - loss(theta - s)) / 2e-4 for s in steps]
    first = [(loss(s) - loss(-s)) / 2e-4 for s in steps]
    assert np.abs(slopes).max() < 0.02 * np.abs(first).max() and here < start
    for _ in range(40):
        assert loss(theta + rng.normal(0, 0.15, 5)) > here


def test_long_stretches_are_decoded_in_time_that_grows_with_them(model):
    token = b"1d1ot5" * 2_000
    times = []
    for n in (1, 8):
        start = time.perf_counter()
        got = toxicity.viterbi(token * n, model.characters)
        times.append(time.perf_counter() - start)
        assert len(got) == len(token) * n
    assert times[1] < 8 * 3 * times[0]
