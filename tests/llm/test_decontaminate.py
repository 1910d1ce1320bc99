"""Decontamination: alignment against the plain recurrence, and planted copies."""

import random

import numpy as np
import pytest

from tiermart.llm import decontaminate as D


def plain_alignment(item, text):
    row, best = [0] * (len(text) + 1), 0
    for w in item:
        after = [0]
        for j, t in enumerate(text, 1):
            after.append(max(0, row[j - 1] + (2 if w == t else -1), row[j] - 1, after[j - 1] - 1))
        row, best = after, max(best, *after)
    return best / (2 * len(item)) if item else 0.0


def test_alignment_equals_recurrence():
    r = random.Random(1)
    for _ in range(400):
        item = [r.randint(1, 5) for _ in range(r.randint(1, 12))]
        text = [r.randint(0, 5) for _ in range(r.randint(0, 20))]
        assert D.align(np.array(item), np.array(text))[0] == pytest.approx(plain_alignment(item, text))


def vocabulary(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    r = random.Random(5)
    words = vocabulary(r, 400)
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(12, 50)))) for i in range(30)]

    def edit(text, share):
        out = []
        for w in text.split():
            x = r.random()
            out += [r.choice(words)] if x < share / 2 else [] if x < share * 0.75 else [w, r.choice(words)] if x < share else [w]
        return " ".join(out)

    docs, truth = [], set()
    for d in range(160):
        body = [r.choice(words) for _ in range(r.randint(0, 300))]
        if d % 2:
            i, text = r.choice(items)
            copy = {1: text, 3: edit(text, 0.08), 5: edit(text, 0.15)}[d % 6].upper()
            at = r.randint(0, len(body))
            body[at:at] = copy.split()
            truth.add((d, i))
        docs.append((d, " ".join(body)))
    docs += [(500 + k, f"{items[0][1]} tail {k}") for k in range(80)]  # one item in a third of all documents
    truth |= {(500 + k, 0) for k in range(80)}
    return items, docs, truth


def brute(items, docs, least=D.LEAST_SCORE):
    """Every document against every item, no seeds."""
    out = {}
    for d, text in docs:
        w = D.words_of(text)
        number = {x: n for n, x in enumerate(dict.fromkeys(w), 1)}
        for i, t in items:
            score, _ = D.align(np.array([number.get(x, -1) for x in D.words_of(t)]), np.array([number[x] for x in w]))
            if score >= least:
                out[d, i] = score
    return out


def test_seeds_and_alignment_find_what_brute_force_finds(spark, docs, planted):
    items, rows, truth = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in D.find(docs(rows, extra=True), benchmark).collect()}
    want = brute(items, rows)
    assert got == pytest.approx(want)
    assert {k for k, s in want.items() if s == 1} <= truth
    assert len(truth & set(got)) >= 0.97 * len(truth) and not set(got) - truth
    left = {r.doc_id for r in D.clean(docs(rows, extra=True), benchmark).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}


def test_blocks_give_the_same(spark, docs, planted, monkeypatch):
    items, rows, _ = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(D.find(docs(rows), benchmark).collect())
    monkeypatch.setattr(D.blocks, "__defaults__", ("item_id", "text", "text", 200))
    assert len(list(D.blocks(benchmark, docs(rows)))) > 3
    assert sorted(D.find(docs(rows), benchmark).collect()) == want


def test_real_copies(real):
    rows = [(r.doc_id, r.text) for r in real("documents").collect()]
    items = [(r.item_id, r.text) for r in real("benchmark").collect()]
    plain = {i: " ".join(D.words_of(t)) for i, t in items}
    exact = {(d, i) for d, t in rows for i, p in plain.items() if f" {p} " in f" {' '.join(D.words_of(t))} "}
    got = {(r.doc_id, r.item_id): r.score for r in D.find(real("documents"), real("benchmark")).collect()}
    assert exact == {k for k, s in got.items() if s == 1.0}


def test_edges(spark, docs):
    benchmark = spark.createDataFrame(
        [(1, "a b"), (2, None), (None, "c d e f g h"), (3, "k l m n o p q r"), (3, "k l m n o p q r"), (4, "")],
        "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "x k l m n o p q r y"), (3, "x k l m n o p q r y"), (None, "K L M, N O P Q R"),
            (4, "a b c d e f g h"), (5, "word " * 50_000 + "k l m n o p q r")]
    got = sorted(((r.doc_id, r.item_id, r.score) for r in D.find(docs(rows), benchmark).collect()), key=str)
    assert got == [(3, 3, 1.0), (3, 3, 1.0), (5, 3, 1.0), (None, 3, 1.0)]
    assert sorted(r.doc_id for r in D.clean(docs(rows), benchmark).collect()) == [1, 2, 4]
    assert D.find(docs([]), benchmark).count() == 0 and D.clean(docs([]), benchmark).count() == 0
    none = benchmark.limit(0)
    assert D.find(docs(rows), none).count() == 0 and D.clean(docs(rows), none).count() == len(rows)


@pytest.mark.parametrize("copies, exact", [(1, 0), (2, 0), (2, 1), (1000, 0), (1000, 1)])
def test_a_repeated_edited_copy_is_found(spark, docs, copies, exact):
    """One word in five replaced: most 4-word seeds are broken, and those left occur in every copy."""
    r = random.Random(9)
    words = vocabulary(r, 400)
    item = [f"item{k}" for k in range(40)]
    edited = [f"other{k}" if k % 5 == 4 else w for k, w in enumerate(item)]

    def around(passage):
        return " ".join(r.choices(words, k=20) + passage + r.choices(words, k=20))
    rows = [(d, around(edited)) for d in range(copies)] + [(5000 + d, around(item)) for d in range(exact)]
    rows += [(9000 + d, around(item[:4])) for d in range(50)]  # a seed that is common, but no copy
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {x.doc_id: x.score for x in D.find(docs(rows), benchmark).collect()}
    assert set(found) == set(range(copies)) | {5000 + d for d in range(exact)}
    assert all(found[d] >= 0.7 for d in range(copies))
    assert {x.doc_id for x in D.clean(docs(rows), benchmark).collect()} == {9000 + d for d in range(50)}


def test_part_of_a_long_item_and_every_fourth_word_replaced(spark, docs):
    r = random.Random(4)
    words = vocabulary(r, 400)
    item = [f"item{k}" for k in range(60)]

    def around(passage):
        return " ".join(r.choices(words, k=20) + passage + r.choices(words, k=20))
    fourth = [f"other{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    rows = [(1, around(item[:33])), (2, around(fourth)), (3, around(item[20:45])), (4, around(item[20:44])), (5, around(item[:3]))]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {x.doc_id: x.score for x in D.find(docs(rows), benchmark).collect()}
    assert got == pytest.approx({1: 33 / 60, 2: (2 * 45 - 14) / 120, 3: 25 / 60})
    assert {x.doc_id for x in D.clean(docs(rows), benchmark).collect()} == {4, 5}


def edited(r, words, others, share, kind):
    """About ``share`` of the words replaced, put in, left out, or each of these."""
    out = []
    for w in words:
        k = kind if kind != "all" else r.choice(("replace", "insert", "delete"))
        if r.random() >= share:
            out.append(w)
        elif k != "delete":
            out += [r.choice(others)] if k == "replace" else [w, r.choice(others)]
    return out


@pytest.mark.parametrize("kind", ["replace", "insert", "delete", "all"])
def test_recall_of_edited_copies_against_brute_force(kind):
    """Common words are drawn as in prose, so chance matches are many; every copy that brute force finds must be found."""
    r = random.Random(kind)
    words = vocabulary(r, 3000)
    weights = [1 / (k + 1) for k in range(len(words))]
    items = [(i, " ".join(r.choices(words, weights, k=r.choice((6, 9, 12, 20, 30, 41, 42, 60, 90, 150))))) for i in range(120)]
    block = D.make_block(items)
    found = wanted = 0
    for i, text in items:
        own = D.words_of(text)
        for share in (0.1, 0.2, 0.3, 0.5, 0.8):
            doc = r.choices(words, weights, k=60) + edited(r, own, words, share, kind) + r.choices(words, weights, k=60)
            number = {x: n for n, x in enumerate(dict.fromkeys(own), 1)}
            score, _ = D.align(np.array([number[w] for w in own]), np.array([number.get(w, 0) for w in doc]))
            if score >= D.least_share(len(own), D.LEAST_SCORE, 10 ** 9):
                wanted += 1
                got = D.contamination(" ".join(doc), block).get(i)
                found += got is not None and got[0] == pytest.approx(score)
    assert wanted > 150 and found == wanted


def test_a_word_put_in_after_every_second_one(spark, docs):
    for m in (12, 30):
        item = [f"item{k}" for k in range(m)]
        doc = [x for k, w in enumerate(item) for x in ([w, f"new{k}"] if k % 2 else [w])]
        found = D.contamination("a b c " + " ".join(doc) + " d e f", D.make_block([(7, " ".join(item))]))
        assert found[0][0] > 0.75


def test_parts_of_long_items_against_brute_force():
    r = random.Random(3)
    words = vocabulary(r, 2000)
    items = [(i, " ".join(r.choices(words, k=r.randint(60, 200)))) for i in range(40)]
    block = D.make_block(items)
    for i, text in items:
        own = D.words_of(text)
        at = r.randint(0, len(own) - 40)
        part = edited(r, own[at:at + 40], words, 0.1, "all")
        doc = r.choices(words, k=50) + part + r.choices(words, k=50)
        number = {x: n for n, x in enumerate(dict.fromkeys(own), 1)}
        score, _ = D.align(np.array([number[w] for w in own]), np.array([number.get(w, 0) for w in doc]))
        got = D.contamination(" ".join(doc), block).get(i)
        assert (got is not None) == (score >= D.LEAST_WORDS / len(own)), (i, score, got)


def test_scripts_without_spaces_are_compared_by_characters():
    item = "中国的首都是哪一座城市请回答"
    block = D.make_block([(1, item), (2, "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย")])
    assert D.words_of("ab中文c d") == ["ab", "中", "文", "c", "d"]
    assert D.contamination(f"前面有一些文字{item}后面也有文字", block)[0][0] == 1.0
    assert D.contamination("xx กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย yy", block)[1][0] == 1.0
    assert 0.6 <= D.contamination("中国的新首都是哪一座大城市请你回答", block)[0][0] < 1
    assert not D.contamination("今天天气很好我们去公园散步吧", block)


def test_short_items_need_nearly_all_of_their_words():
    block = D.make_block([(0, "a b"), (1, "red green blue"), (2, "one two three four five six")])
    assert not D.contamination("a b red green x y one two three x four", block)
    assert {i for i in D.contamination("x red green blue one two three four x five six", block)} == {1, 2}


def test_every_block_is_one_pass_and_a_large_benchmark_is_one_block(spark, docs):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(50))) for i in range(6000)]  # 300,000 words
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.find(docs([(1, items[17][1]), (2, "nothing of that")]), benchmark)
    assert found._jdf.queryExecution().toString().count("MapInArrow") <= 4  # the same one in each of the plans
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 17)]
