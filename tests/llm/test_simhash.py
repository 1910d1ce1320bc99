"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash

from tiermart.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(pairs, radius=3):
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            if (a ^ pairs[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(pairs):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, least.get(find(i))) for i, (k, _) in enumerate(pairs)]


TEXTS = [(5, "The quick brown fox jumps"), (3, "the QUICK brown fox jumps"), (9, None), (8, ""), (7, " \t\x0b\n"),
         (4, "two words"), (4, "two words"), (2, "Äb c d É é"), (1, "a b c " * 400), (None, "a b c " * 400),
         (None, "lonely text of an unnamed row"), (6, "x")]


def test_fingerprints(docs):
    got = simhash.fingerprints(docs(TEXTS, extra=True)).collect()
    assert sorted((r.doc_id or -1, r.fp % (1 << 64)) for r in got) == sorted(
        (k or -1, brute_fingerprint(t)) for k, t in TEXTS)


def test_components_of_small_and_real_texts(docs, real):
    for df in (docs(TEXTS), real("documents")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = brute_components([(k, brute_fingerprint(t)) for k, t in rows])
        got = [(r.doc_id, r.component) for r in simhash.near_duplicates(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def near_copies(n, seed):
    """Values in tight balls around a few centres, and chains of single bits."""
    rng = random.Random(seed)
    out = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(n):
            v = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            out.add(v)
        for _ in range(n // 2):
            c ^= 1 << rng.randrange(64)
            out.add(c)
    return sorted(out)


def test_links_connect_what_brute_force_connects(spark):
    """Also with cells of two fingerprints, where every shard is cut into many chunks."""
    from tiermart.llm.components import connected_components

    values = near_copies(12, 3)
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    want = brute_components([(v, v) for v in values])
    groups = {k: c for k, c in want}
    for cell in (2, 4096):
        found = {r.node % (1 << 64): r.root for r in connected_components(simhash.links(fps, cell=cell)).collect()}
        roots = {}
        for v in values:
            roots.setdefault(found.get(v, ("alone", v)), set()).add(groups[v])
        assert all(len(g) == 1 for g in roots.values()) and len(roots) == len(set(groups.values()))


def test_bk_tree_finds_all_within_radius():
    values = np.array(near_copies(30, 5), dtype=np.uint64)
    found = {(int(values[n]), int(values[q])) for n, at in simhash.BKTree(values).within(values, 3) for q in at}
    assert found == {(int(a), int(b)) for a in values for b in values if int(a ^ b).bit_count() <= 3}


def test_one_document_of_each_group_stays(docs):
    kept = simhash.keep_representatives(docs(TEXTS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    want = sorted({c for k, c in brute_components([(k, brute_fingerprint(t)) for k, t in TEXTS if k is not None])})
    assert ids == want
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_no_rows(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_representatives(docs([])).count() == 0
