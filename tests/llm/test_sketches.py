"""Threshold-scaled sketches against sets of shingles."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tiermart.llm import sketches


def next_of(rows):
    """(key, text) rows -> next text by ascending key (unique, not null)."""
    rows = sorted(rows)
    return {k: rows[(i + 1) % len(rows)][1] or "" for i, (k, _) in enumerate(rows)}


def edit(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@pytest.mark.parametrize("per_range", [1, 3, 2000])
def test_edited_texts(docs, per_range, monkeypatch):
    monkeypatch.setattr(sketches.with_next, "__defaults__", (None, "next", per_range))
    rows = [(k, t) for k, t in zip(
        [5, -7, 100, 101, 102, 103, 104, 10**15, 10**15 + 1, 0],
        ["abcdef", None, "", "\U0001f600é x", "one two three four five six seven", "x" * 5000, "y", "z z z z z z", "end", "a"])]
    found = sketches.edit_likeness(docs(rows, extra=True)).collect()
    following = next_of(rows)
    assert {r.doc_id: r.edited for r in found} == {k: edit(t or "", following[k]) for k, t in rows}
    own = {r.doc_id: r.sketch for r in found}
    order = sorted(k for k, _ in rows)
    assert all(r.next_sketch == own[order[(order.index(r.doc_id) + 1) % len(order)]] for r in found)
    assert {r.doc_id: r.n_chars for r in found} == {k: len(t or "") for k, t in rows}


def test_null_and_repeated_keys_each_get_a_row(docs):
    rows = [(None, "n one"), (None, "n two"), (1, "a b c d"), (1, "a b c d"), (2, "e")]
    found = sketches.edit_likeness(docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "1", "2", "None", "None"]
    assert [r.edited for r in sketches.edit_likeness(docs([(1, "abcd")])).collect()] == ["abab"]
    assert sketches.edit_likeness(docs([])).count() == 0


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_sketch_estimates_likeness_and_containment(docs):
    r = random.Random(1)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    big = [r.choice(vocabulary) for _ in range(6000)]
    texts = {1: " ".join(big), 2: " ".join(big[1000:3000]), 3: " ".join(r.choice(vocabulary) for _ in range(3000)),
             4: " ".join(big[:3000])}
    df = sketches.with_sketch(docs(list(texts.items())))
    got = {x.doc_id: x.sketch for x in df.collect()}
    for k, t in texts.items():
        n = len(shingle_set(t))
        assert abs(len(got[k]) - n / sketches.SCALE) < 5 * (n / sketches.SCALE) ** 0.5
        assert got[k] == sorted(set(got[k]))
    pairs = df.alias("a").join(df.alias("b"), F.col("a.doc_id") < F.col("b.doc_id")).select(
        F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"),
        sketches.likeness(F.col("a.sketch"), F.col("b.sketch")).alias("like"),
        sketches.containment(F.col("b.sketch"), F.col("a.sketch")).alias("inside"),
        sketches.merge(F.col("a.sketch"), F.col("b.sketch")).alias("merged")).collect()
    for p in pairs:
        a, b = shingle_set(texts[p.a]), shingle_set(texts[p.b])
        assert p.like == pytest.approx(len(a & b) / len(a | b), abs=0.08)
        assert p.inside == pytest.approx(len(a & b) / len(b), abs=0.12)
        bound = -(1 << 63) + (1 << 64) // sketches.SCALE
        assert [h for h in p.merged if h < bound] == sorted({h for h in got[p.a] + got[p.b] if h < bound})


def test_equal_texts_and_blank_texts(docs):
    df = sketches.with_sketch(docs([(1, "Same text here"), (2, "same  TEXT here"), (3, None), (4, " \n"), (5, "other")]))
    got = {r.doc_id: r.sketch for r in df.collect()}
    assert got[1] == got[2] and len(got[1]) == 1 and got[3] == got[4] == [] and got[5] != got[1]


def test_query_columns(spark):
    from tiermart.llm.queries import op9_fingerprints

    rows = op9_fingerprints(spark, "/root/testdata/sf0.001").collect()
    source = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    following = next_of(list(source.items()))
    assert len(rows) == len(source)
    for r in rows:
        assert r.edited_sha256 == hashlib.sha256(edit(source[r.doc_id], following[r.doc_id]).encode()).hexdigest()
        assert r.n_chars == len(source[r.doc_id]) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_text = {}
    for r in rows:
        assert by_text.setdefault(source[r.doc_id], r.fingerprint) == r.fingerprint


def test_ranges_grow_instead_of_their_number(docs, monkeypatch):
    """What is known of the ranges stays bounded; the result is the same."""
    rows = [(k * k, f"text number {k} with some words in it") for k in range(400)]
    want = sorted(map(tuple, sketches.edit_likeness(docs(rows)).collect()), key=str)
    monkeypatch.setattr(sketches, "MOST_RANGES", 7)
    monkeypatch.setattr(sketches.with_next, "__defaults__", (None, "next", 1))
    assert sorted(map(tuple, sketches.edit_likeness(docs(rows)).collect()), key=str) == want
