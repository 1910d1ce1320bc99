"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tiermart.llm import periodic
from tiermart.llm.queries import op11_periodic_runs, repeated_tail


def brute_runs(words, repeats=4, least_words=6):
    n, out = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i:i + length]
            smaller = any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q))
            if length >= max(least_words, repeats * q) and not smaller:
                out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    return [w for k, w in enumerate(words) if not any(s + q <= k < s + length for s, length, q in runs)]


def sequences(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < r.randint(0, 90):
            if r.random() < 0.5:
                period = [r.choice("abc") for _ in range(r.randint(1, 9))]
                words += (period * r.randint(1, 8))[:r.randint(1, 60)]
            else:
                words += [r.choice("abcdef") for _ in range(r.randint(1, 6))]
        yield words


def test_runs_equal_brute_force():
    for words in sequences(1, 600):
        ids = np.array([ord(c) for c in words], dtype=np.int64)
        assert [tuple(x) for x in periodic.runs_of(ids).tolist()] == brute_runs(words), words


def test_few_repeats_are_refused():
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(3, np.int64), repeats=3)


def test_rows_do_not_meet_and_edge_cases_have_results(docs, monkeypatch):
    texts = [" ".join(w) for w in sequences(2, 60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [
        (100, None), (101, ""), (102, " \t\n "), (103, "x " * 50_000), (None, "a a a a a a a"), (100, None),
        (5, texts[5]), (104, "a" * 100_000), (105, "b b b b b b")]
    monkeypatch.setattr(periodic, "CHUNK_BYTES", 300)
    got = periodic.find_runs(docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    want = []
    for k, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = brute_runs(words) if len(words) < 1000 else [(0, 50_000, 1)]
        want.append((k, len(words), runs, " ".join(brute_collapsed(words, runs) if len(words) < 1000 else ["x"])))
    have = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_no_rows(docs):
    assert periodic.find_runs(docs([])).count() == 0


def test_invalid_utf8_is_bytes(spark):
    df = spark.sql("select 1L as doc_id, cast(x'FF20FF20FF20FF20FF20FF20FF' as string) as text")
    got = periodic.find_runs(df).selectExpr("runs", "hex(cast(collapsed as binary)) as c").first()
    assert [tuple(x) for x in got.runs] == [(0, 7, 1)] and got.c == "FF"


def test_the_query_equals_brute_force(spark, real):
    got = {r.doc_id: r for r in op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in real("documents").select("doc_id", "text").collect()}
    assert set(got) == set(texts)
    planted = 0
    for k, text in texts.items():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(k).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 1500:
            continue
        runs = brute_runs(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[k]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapsed(words, runs))).hexdigest()
    assert planted > 5 and any(r.n_runs for r in got.values())


def test_tail_of_a_document_without_an_id_stays():
    assert repeated_tail(None, [b"a", b"b"]) == [b"a", b"b"]
