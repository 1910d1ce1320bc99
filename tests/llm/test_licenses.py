"""License rules against a plain reading with Python's regex engine."""

import random
import re

import pytest

from tiermart.llm import licenses as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

TEXTS = [
    (1, "Released under the MIT License."), (2, None), (3, ""), (4, "..."),
    (5, "MIT license mit  license; MIT-License, mitlicense MIT licenses"),
    (6, "This program is free software; you can redistribute it. GNU General Public License, version 3 or later."),
    (7, "GNU Affero General Public License v3 and Lesser General Public License 2.1"),
    (8, "SPDX-License-Identifier: BSD-3-Clause\nLicensed under the Apache License, Version 2.0 (the License)"),
    (9, "Licensed under CC BY-NC 4.0. Kelvin mİt license Éapache license"),
    (10, "mit und ohne, der apache"), (11, "all rights reserved " * 300), (12, "word " * 20_000 + "apache license"),
    (12, "word " * 20_000 + "apache license"), (None, "Mozilla Public License 2.0"), (13, "a\x01b\x00mit license"),
]


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    base = sorted((i, label) for phrase, label in L.BASE for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())
    norm, spans = " ".join(w), []
    for rule in L.rules():
        if rule["keyword"] in norm:
            for m in re.finditer(rule["regex"], norm):
                first = norm.count(" ", 0, m.start())
                spans.append((first, first + m.group().count(" "), rule["tier"], rule["n"], rule["label"], rule["weight"]))
    kept = sorted(s for s in spans if not any(
        t[0] <= s[0] and t[1] >= s[1] and t[2] <= s[2] and (t[1] - t[0] > s[1] - s[0] or t[2] < s[2] or t[3] < s[3])
        for t in spans))
    return len(w), base, kept


def spelled(regex, r):
    """A random text that the regex matches."""
    def out(items):
        text = ""
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                text += chr(arg)
            elif name == "NOT_LITERAL":
                text += "q"
            elif name == "IN":
                kind, value = r.choice([x for x in arg if str(x[0]) != "NEGATE"])
                if str(arg[0][0]) == "NEGATE":
                    text += "q"
                else:
                    text += chr(value) if str(kind) == "LITERAL" else chr(r.randint(*value))
            elif name == "BRANCH":
                text += out(r.choice(arg[1]))
            elif name == "SUBPATTERN":
                text += out(arg[3])
            elif name == "MAX_REPEAT":
                text += "".join(out(arg[2]) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 2))))
            elif name not in ("ASSERT", "ASSERT_NOT"):
                raise ValueError(name)
        return text
    return out(re._parser.parse(regex))


def test_gate_and_keywords_lose_no_match():
    rules, r = L.rules(), random.Random(1)
    assert len(rules) >= 200
    for rule in rules:
        for _ in range(60):
            text = spelled(rule["regex"], r)
            assert re.search(rule["regex"], text), (rule, text)
            assert rule["keyword"] in text, (rule["label"], rule["keyword"], text)
            assert any(g in text for g in L.GATES), text


def test_scan_equals_brute_force(docs, real):
    for df in (docs(TEXTS, extra=True), real("documents")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got = sorted(((r.doc_id, r.n_words, [tuple(b) for b in r.base], [tuple(s) for s in r.spans])
                      for r in L.scan(df).collect()), key=str)
        assert got == sorted(((k, *brute(t)) for k, t in rows), key=str)


def test_no_rows(docs):
    assert L.scan(docs([])).count() == 0


def test_query(spark):
    from tiermart.llm.queries import op10_licenses

    for r in op10_licenses(spark, "/root/testdata/sf0.001").collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.n_base == 0) == (r.first_word is None) == (r.base_labels == "")


def test_a_url_swallows_no_later_license(docs):
    bsd, cc = "http://www.opensource.org/licenses/bsd-license.php", "https://creativecommons.org/licenses/by-sa"
    rows = [(1, f"See {bsd} and also code licensed under the Apache License, Version 2.0"),
            (2, f"{bsd} some words, then the GNU General Public License version 3 and so on to the end"),
            (3, f"{cc}/ and the Mozilla Public License 2.0"), (4, f"{cc}, GPL 2.0"), (5, f"see {cc}/2.1/jp or MIT License"),
            (6, "opensource.org/licenses/BSD-3-Clause"), (7, "creativecommons.org/licenses/by-nc-nd/4.0/deed.en")]
    got = {r.doc_id: [s.label for s in r.spans] for r in L.scan(docs(rows)).collect()}
    assert got == {1: ["bsd", "apache-2.0"], 2: ["bsd", "gpl-3.0"], 3: ["cc", "mpl-2.0"], 4: ["cc", "gpl-2.0"],
                   5: ["cc", "mit"], 6: ["bsd"], 7: ["cc"]}
    ends = {r.doc_id: r.spans[0].last for r in L.scan(docs(rows)).collect()}
    assert ends[6] == 5 and ends[7] == 7 and ends[5] == 8


@pytest.mark.parametrize("text, want", [
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", {"apache-2.0", "mit"}),
    ("// SPDX-License-Identifier: (BSD-3-Clause AND MIT)", {"bsd-3-clause", "mit"}),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath OR MPL-2.0 OR ISC", {"gpl-2.0", "mpl-2.0", "isc"}),
    ("It is released under the MIT.", {"mit"}),
    ("License: MIT", {"mit"}), ('license = "MIT"', {"mit"}), ("The license is ISC", {"isc"}),
    ("dual-licensed under the GPL and MIT", {"gpl", "mit"}),
    ("distributed under the terms of the GPLv3 or the Apache 2.0", {"gpl-3.0", "apache-2.0"}),
    ("Der Hund ging mit der Katze, released in mit", set()), ("mit, gpl and bsd are words", set()), ("a licence plate with mit on it", set()),
])
def test_operands_and_short_names(spark, docs, text, want):
    found = L.scan(docs([(1, f"head {text}\nand on")])).selectExpr("transform(spans, s -> s.label) as l").first().l
    assert set(found) == want, found


def test_suppression_by_a_sweep_equals_every_pair(spark):
    r = random.Random(8)
    rows = []
    for k in range(300):
        spans = []
        for n in range(r.randint(0, 14)):
            a = r.randint(0, 12)
            spans.append((a, a + r.randint(0, 5), r.randint(1, 3), n, f"l{n}", 0.5))
        rows.append((k, spans))
    df = spark.createDataFrame(rows, f"k int, spans {L.SPAN_TYPE}")
    got = {x.k: {s.n for s in x.kept} for x in df.select("k", L._suppressed(df.spans).alias("kept")).collect()}
    for k, spans in rows:
        want = {s[3] for s in spans if not any(
            t[0] <= s[0] and t[1] >= s[1] and t[2] <= s[2] and (t[1] - t[0] > s[1] - s[0] or t[2] < s[2] or t[3] < s[3]) for t in spans)}
        assert got[k] == want, spans
