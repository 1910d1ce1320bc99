"""Line dedup against a direct statement of its rule, and its guarantees."""

import random

import pytest
from pyspark.sql import functions as F

from tiermart.llm import lines

T, K = lines.LEAST_CHARS, lines.MOST_LINES


def brute(rows):
    """(doc_id, text) -> {(doc_id, text): (kept text, removed lines)}, by the rule in the module's docstring."""
    found = sorted({(k is None, k or 0, t) for k, t in rows if t is not None})
    places = {}
    seeds = []
    split = {}
    for none, k, text in found:
        doc = (none, k, text)
        ls = [x.strip(" \t\r") for x in text.split("\n")]
        split[doc] = ls
        size = []
        for i in range(len(ls)):
            chars = n = 0
            while i + n < len(ls) and n < K and chars < T:
                chars += len(ls[i + n])
                n += 1
            size.append(n if chars >= T or (n == K and chars >= K) else 0)
        chosen = set()
        for i, n in enumerate(size):
            if n:
                inside = [(tuple(ls[j:j + size[j]]), j) for j in range(i, i + n) if size[j]]
                chosen.add((i, n, tuple(inside)))
        seeds.append((doc, ls, size, chosen))
    return found, split, seeds


def longest_shared(rows_out, least=T):
    seen, again = set(), []
    for text in rows_out:
        for line in (text or "").split("\n"):
            line = line.strip(" \t\r")
            if len(line) >= least:
                if line in seen:
                    again.append(line)
                seen.add(line)
    return again


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def corpus(seed):
    r = random.Random(seed)
    passages = [[sentence(r, 30)], [sentence(r, 6) for _ in range(12)], [sentence(r, 60), "", sentence(r, 5)]]
    rows = []
    for i in range(60):
        ls = [sentence(r, r.choice([1, 4, 30])) for _ in range(r.randint(0, 12))]
        for p in passages:
            if r.random() < 0.4:
                at = r.randint(0, len(ls))
                ls[at:at] = p
        rows.append((i, "\n".join(ls)))
    return rows, passages


def run(docs, rows, **kw):
    return lines.remove_repeated_lines(docs(rows, **kw)).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_long_lines_stay_once_and_nothing_is_lost(docs, seed):
    rows, passages = corpus(seed)
    out = run(docs, rows)
    assert len(out) == len(rows)
    assert not longest_shared(r.text for r in out)
    kept = {x.strip() for r in out for x in r.text.split("\n")}
    assert {x.strip() for _, t in rows for x in t.split("\n")} - {""} <= kept
    for p in passages:  # a passage of short lines is gone from all documents but one, save at most its edges
        whole = "\n".join(p)
        assert sum(whole in r.text for r in out) <= 1
    for r, (k, t) in zip(sorted(out), rows):
        left = iter(t.split("\n"))
        assert all(any(x == y for y in left) for x in r.text.split("\n") if r.text)  # a subsequence of its lines
        assert r.n_lines == len(t.split("\n"))
        assert r.n_removed == r.n_lines - (len(r.text.split("\n")) if r.text or r.n_removed < r.n_lines else 0)


def test_clean_documents_are_untouched(docs):
    r = random.Random(4)
    rows = [(i, "\n".join(["The.", "Of it.", sentence(r, 40), "The."])) for i in range(20)]
    assert [(x.doc_id, x.text, x.n_removed) for x in sorted(run(docs, rows))] == [(k, t, 0) for k, t in rows]


def test_first_place_is_by_id_then_position(docs):
    p = "passage " * 20
    out = {r.doc_id: r.text for r in run(docs, [(7, f"x\n{p}\ny\n{p}"), (3, f"{p}"), (None, f"z\n{p}"), (9, p + "  \r")])}
    assert out == {7: "x\ny", 3: p, None: "z", 9: ""}


def test_run_inside_one_document(docs):
    a, b = "a" * 120, "b" * 120
    out = run(docs, [(1, "\n".join([a, b, a, b, a, b]))])
    assert out[0].text == f"{a}\n{b}" and out[0].n_removed == 4


def test_edges_are_extended(docs):
    p = "p" * 150
    rows = [(1, f"head\nshort before\n{p}\nshort after\ntail"), (2, f"other\nshort before\n{p}\nshort after\nend")]
    assert {r.doc_id: r.text for r in run(docs, rows)}[2] == "other\nend"


def test_nulls_empties_repeats_extras(docs):
    p = "same text " * 15
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, p), (4, p), (None, None), (5, "long " * 50_000)]
    out = run(docs, rows, extra=True)
    assert len(out) == len(rows)
    assert sorted((str(r.doc_id), r.n_removed) for r in out) == sorted((str(k), 0) for k, _ in rows)  # 4 is one document
    assert {r.doc_id: r.n_lines for r in out}[3] == 3 and [r.text for r in out if r.doc_id == 1] == [None]
    assert lines.remove_repeated_lines(docs([])).count() == 0


def test_selected_fingerprints_are_window_minima(docs, spark):
    rows, _ = corpus(3)
    marks = lines.fingerprints(docs(rows)).collect()
    at = {}
    for m in marks:
        at.setdefault(m["__key"], {})[m["at"]] = (m["size"], m["hash"])
    for none, k, text in brute(rows)[0]:
        doc, ls, size, chosen = next(s for s in brute([(k, text)])[2])
        content = {j: tuple(ls[j:j + n]) for j, n in enumerate(size) if n}
        values = spark.createDataFrame([(j, list(c)) for j, c in content.items()], "j int, c array<string>")
        hashes = {r.j: r.h for r in values.select("j", F.xxhash64(F.transform("c", lambda x: F.xxhash64(x))).alias("h")).collect()} \
            if content else {}
        want = {min(((hashes[j], j) for j in range(i, i + n) if j in hashes))[1] for i, n in enumerate(size) if n}
        assert set(at.get(k, {})) == want
        assert all(at[k][j] == (size[j], hashes[j]) for j in want)
        if k > 6:
            break
