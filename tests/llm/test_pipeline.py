"""The pipeline's stages in order, against brute force and planted cases."""

import random

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_decontaminate import brute as copies_of_items
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered_with_its_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "source_mixing"]
    queries = __spark_entry__.queries()
    assert "pipeline" in queries and all(any(q.startswith(f"op{n}_") for q in queries) for n in range(1, 11))


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's input and output rows over the smallest real tables, each written and reread."""
    out, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: ([r.asDict() for r in a.collect()], [r.asDict() for r in b.collect()], b.columns) for name, a, b in out}


def test_stages_return_documents(results):
    for name, _, columns in ((n, r[1], r[2]) for n, r in results.items() if n != "source_mixing"):
        assert columns == COLUMNS, name


def test_toxicity_rejects_labelled_documents(spark, results):
    before, after, _ = results["toxicity"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [d for d in labels if (d in gone) != bool(labels[d])]
    assert gone and len(wrong) <= 0.1 * len(labels)
    kept = {r["doc_id"]: r for r in after}
    assert all(kept[r["doc_id"]] == r for r in before if r["doc_id"] in kept)


def test_line_dedup(results):
    before, after, _ = results["line_dedup"]
    texts = {r["doc_id"]: r["text"] for r in before}
    seen = set()
    for r in sorted(after, key=lambda r: r["doc_id"]):
        assert r["n_chars"] == len(r["text"]) and r["text"].strip() or r["text"] == texts[r["doc_id"]]
        for line in (x.strip() for x in r["text"].split("\n")):
            assert len(line) < 100 or line not in seen
            seen.add(line)
    assert {x.strip() for t in texts.values() for x in t.split("\n")} - {""} <= {
        x.strip() for r in after for x in r["text"].split("\n")}


def test_near_dedup(results):
    before, after, _ = results["near_dedup"]
    groups = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, c in groups})


def test_decontamination(spark, results):
    before, after, _ = results["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    copies = copies_of_items(items, [(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({r["doc_id"] for r in before} - {d for d, _ in copies})


def test_mixing(spark, results):
    before, after, columns = results["source_mixing"]
    assert columns == COLUMNS + ["size", "source_size", "target", "taken"]
    rows = [(r["doc_id"], r["text"], None, r["source"]) for r in before]
    from tiermart.llm import mixing
    docs = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in before],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    check_mix(rows, mixing.mix(docs).collect())
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(docs).collect() if r.taken) == sorted(
        (r["doc_id"], r["taken"]) for r in after)


def test_run_equals_its_stages(spark, results):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.taken) for r in got.collect()) == sorted(
        (r["doc_id"], r["taken"]) for r in results["source_mixing"][1])


def test_planted_cases(spark, tmp_path):
    """Toxic, copied, leaked and repeated documents go or shrink; clean ones reach the mix whole."""
    r = random.Random(9)
    words = ["".join(r.choice("aeiourstlnm") for _ in range(r.randint(3, 8))) for _ in range(4000)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n))
    passage = prose(70)
    items = [(i, prose(30)) for i in range(10)]
    clean = [(i, f"{prose(60)}\n{prose(40)}") for i in range(400)]
    toxic = [(1000 + i, f"{prose(30)} horrid {prose(20)} vileword {prose(5)}") for i in range(80)]
    exact = [(2000 + i, clean[i][1]) for i in range(20)]
    leaks = [(3000 + i, f"{prose(20)} {items[i % 10][1]} {prose(20)}") for i in range(20)]
    shared = [(4000 + i, f"{prose(40)}\n{passage}\n{prose(40)}") for i in range(30)]
    odd = [(5000, None), (5001, ""), (5002, "\n \n"), (None, prose(50))]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in clean + toxic + exact + leaks + shared + odd]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 1000)) for k, _ in clean[::2] + toxic[::2]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert all(got[k].text == t and got[k].taken == len(t.split()) for k, t in clean)
    assert not set(got) & {k for k, _ in toxic + exact + leaks}
    assert sum(passage in got[k].text for k, _ in shared) == 1 and all(k in got for k, _ in shared)


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
