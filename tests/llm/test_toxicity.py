"""Ordinal regression: gradient, order of thresholds, held-out accuracy."""

import random

import numpy as np
import pytest

from tiermart.llm import toxicity as T


def likelihood(w, t, rows, grades, weight):
    total = 0.0
    for r, g, v in zip(rows, grades, weight):
        s = w[r].sum()
        above = [1.0] + [1 / (1 + np.exp(k - s)) for k in t] + [0.0]
        total += v * np.log(above[g] - above[g + 1])
    return total / weight.sum()


def test_fit_beats_nearby_parameters():
    r = np.random.default_rng(3)
    rows = [np.flatnonzero(r.random(6) < 0.4) for _ in range(400)]
    true = np.array([2.0, 1.0, 0.0, -1.0, 0.5, 0.0])
    latent = np.array([true[x].sum() for x in rows]) + r.logistic(size=400)
    grades = np.searchsorted([0.5, 1.5, 3.0], latent)
    weight = r.uniform(0.5, 1.5, 400)
    w, t = T.fit_ordinal(rows, grades, weight, 6, penalty=0.0, steps=1500)
    best = likelihood(w, t, rows, grades, weight)
    assert (np.diff(t) > 0).all() and np.abs(w - true).max() < 0.8
    for k in range(9):
        for d in (-0.05, 0.05):
            v, u = w.copy(), t.copy()
            (v if k < 6 else u)[k if k < 6 else k - 6] += d
            assert likelihood(v, u, rows, grades, weight) <= best + 1e-4


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(2000)]
    bad = ["zorgle", "frumpk", "quazzle", "blixt"]
    rows = []
    for i in range(3000):
        text = [r.choice(words) for _ in range(r.randint(5, 120))]
        toxic = r.random() < 0.15
        if toxic:
            for _ in range(r.randint(1, 6)):
                text.insert(r.randint(0, len(text)), r.choice(bad).upper())
        rows.append((i, " ".join(text), int(toxic) if r.random() > 0.02 else 1 - int(toxic), toxic))
    return rows


def test_held_out_accuracy_and_graded_severity(spark, corpus):
    train = spark.createDataFrame([(x[1], x[2]) for x in corpus if x[0] % 2], "text string, toxic int")
    model = T.fit(train)
    test = [x for x in corpus if not x[0] % 2]
    df = spark.createDataFrame([(x[0], x[1], "y") for x in test], "doc_id long, text string, GRADE string")
    got = T.score(df, model)
    assert got.columns == ["doc_id", "text", "severity", "grade", "rejected"]
    got = {r.doc_id: r for r in got.collect()}
    right = sum(got[x[0]].rejected == x[3] for x in test)
    assert right >= 0.99 * len(test)
    one, many = [T._severities(model, {}, [t])[0] for t in ("zorgle", "zorgle frumpk quazzle blixt")]
    assert 0 <= one < many <= len(model.thresholds)


def test_scores_by_hand(spark):
    model = T.Model({T.word_hash("bad"): 2.0, T.word_hash("ugly"): 1.0}, np.array([1.0, 2.0]))
    rows = [(1, "A bad, BAD day"), (2, None), (3, ""), (4, "bad ugly " * 30_000), (1, "A bad, BAD day"), (None, "ugly")]
    got = T.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()

    def severity(s):
        return sum(1 / (1 + np.exp(t - s)) for t in (1.0, 2.0))
    want = [severity(2), severity(0), severity(0), severity(3), severity(2), severity(1)]
    assert [r.severity for r in got] == pytest.approx(want)
    assert [r.rejected for r in got] == [s >= T.REJECT_FROM for s in want]
    assert [r.grade for r in got] == [round(s) for s in want]


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "text string, toxic int")
    one_kind = spark.createDataFrame([("a b c", 0), (None, 1), ("x", None)], "text string, toxic int")
    for labelled in (empty, one_kind):
        model = T.fit(labelled)
        got = T.score(spark.createDataFrame([(1, "x")], "doc_id long, text string"), model).collect()
        assert [(r.severity, r.rejected) for r in got] == [(0.0, False)]
    assert T.score(spark.createDataFrame([], "doc_id long, text string"), T.Model({}, np.zeros(0))).count() == 0
