"""Source mixing against sharing by hand."""

import re

import pytest

from tiermart.llm import mixing


def brute_targets(sizes):
    """Repeated sharing; sizes by source in code-point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    rest, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > 3 * sizes[s]]
        if not over:
            out.update({s: rest * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            open_.discard(s)
        rest = sum(sizes.values()) - sum(out.values())
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    """rows: (doc_id, text, lang, source); got: collected mix with doc_id and source."""
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    targets = brute_targets(sizes)
    taken = {}
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-9, rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        spread = {t.taken // t.size for t in got if t.source == r.source and t.size}
        assert not spread or max(spread) - min(spread) <= 1  # whole passes before anything more
    for s in sizes:
        assert taken[s] == int(targets[s] + 1e-9)


ROWS = ([(i, "w " * (i % 7), None, "big") for i in range(300)] + [(1000 + i, "a\tb\x0bc d", None, "b") for i in range(3)]
        + [(2000, None, None, None), (2001, "one two", None, None), (2002, "", None, ""), (2003, "x y z", None, "é"),
           (2004, "x y z", None, "é"), (2004, "x y z", None, "é"), (None, "n u l l", None, "big"), (None, None, None, "only null")]
        + [(3000, "long " * 50_000, None, "Z")])


@pytest.mark.parametrize("rows_per_range", [3, 10_000])
def test_mix_reaches_targets(docs, rows_per_range):
    df = docs(ROWS, extra=True)
    got = mixing.mix(df, keep=("doc_id", "source", "text"), rows_per_range=rows_per_range)
    assert got.columns == ["doc_id", "source", "text", "size", "source_size", "target", "taken"]
    rows = got.collect()
    assert all(r.size == words(r.text) for r in rows)
    check(ROWS, rows)
    again = mixing.mix(df.repartition(5), keep=("doc_id", "source", "text"), rows_per_range=rows_per_range).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_real_documents(real):
    df = real("documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]
    check(rows, mixing.mix(df, keep=("doc_id", "source")).collect())


def test_no_rows_and_no_words(docs):
    assert mixing.mix(docs([])).count() == 0
    assert [r.taken for r in mixing.mix(docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_many_sources_are_not_broadcast(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    check(ROWS, mixing.mix(docs(ROWS), keep=("doc_id", "source")).collect())


def test_no_row_is_moved_by_the_cut(spark, docs):
    """Neither a window nor an exchange stands above the scan of the texts: rows compare their key with the cut."""
    rows = [(k, "word " * (k % 7 + 1), None, f"s{k % 3}") for k in range(500)]
    plan = mixing.mix(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_equal_rows_at_the_cut_share_it(docs):
    rows = [(1, "a b c d", None, "x")] * 50 + [(k, "w " * 40, None, "y") for k in range(2, 60)]
    got = mixing.mix(docs(rows), weights=(1.0, 5.0)).collect()
    taken = {r.taken for r in got if r.source == "x"}
    target = next(r.target for r in got if r.source == "x")
    assert len(taken) == 1 and 0 <= target - 50 * taken.pop() < 50
