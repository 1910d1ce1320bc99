"""Quality: exact sums, calibration by brute force, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermart.llm import quality
from tiermart.llm.queries import op12_quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return quality.described(docs).join(labels, "doc_id").cache()


def test_statistics_are_finite_numbers():
    for text in (None, "", " \n\t", "a", "A!! B!!", "x " * 30_000, "\ud800", "İ" * 10, "%%% %%%", "ß\n\nß", "1 2 3"):
        got = quality.statistics(text)
        assert len(got) == len(quality.STATISTICS) and np.isfinite(got).all(), text
    named = dict(zip(quality.STATISTICS, quality.statistics("AB cd cd.\nAB cd cd.")))
    assert named["same_neighbour"] == 0 and named["same_lines"] == 0.5 and named["line_ends"] == 1
    assert named["upper"] == 4 / 12 and named["distinct_words"] == 0.5 and named["shouting"] == 2 / 6


def test_partition_sums_equal_one_matrix_product(labelled):
    rows = labelled.select(F.col("label").cast("double").alias("label"), "fold", "statistics")
    n = len(quality.STATISTICS)
    r = np.random.default_rng(1)
    model = quality.Model(np.zeros(n), np.ones(n), r.normal(size=(n, 9)), r.uniform(size=9), np.zeros(10), np.zeros(1), np.zeros(1))
    got, held = quality.normal_equations(rows.repartition(7), model)
    again, _ = quality.normal_equations(rows.coalesce(1), model)
    assert (got == again).all()
    local = rows.toPandas()
    z = np.concatenate([model.features(np.stack(local.statistics)), local.label.values[:, None]], axis=1)
    for f in range(quality.FOLDS):
        own = z[local.fold.values % quality.FOLDS == f]
        assert np.allclose(got[f], own.T @ own) and held[f] == len(own)


def test_ridge_solution_has_no_slope():
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(50, 4)), np.ones((50, 1))], axis=1)
    y = r.integers(0, 2, 50).astype(float)
    z = np.concatenate([x, y[:, None]], axis=1)
    w = quality.solve(z.T @ z, 50, 0.1)
    slope = x.T @ (x @ w - y) + 0.1 * 50 * np.array([1, 1, 1, 1, 0]) * w
    assert np.abs(slope).max() < 1e-6


def test_features_approximate_a_gaussian_kernel():
    r = np.random.default_rng(3)
    n, features, width = len(quality.STATISTICS), 20_000, 4.0
    model = quality.Model(np.zeros(n), np.ones(n), r.normal(size=(n, features)) / width, r.uniform(0, 2 * np.pi, features),
                          np.zeros(1), np.zeros(1), np.zeros(1))
    x = r.normal(size=(6, n))
    z = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * width ** 2))
    assert np.abs(2 * z @ z.T / features - kernel).max() < 0.04


def test_rising_equals_least_squares_over_all_cuts():
    r = np.random.default_rng(4)
    for _ in range(40):
        n = int(r.integers(1, 8))
        at, w = np.sort(r.random(n)), r.integers(1, 5, n).astype(float)
        yes = np.minimum(r.integers(0, 5, n), w).astype(float)
        x, level = quality.rising(at, yes, w)
        got = np.interp(at, x, level)
        assert (np.diff(got) >= -1e-12).all()
        # The isotonic fit at i: the largest over starts of the least over ends of the pooled mean.
        want = [max(min(yes[a:b + 1].sum() / w[a:b + 1].sum() for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    got = op12_quality(spark, FOLDER).toPandas()
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert (got.held_out == [zlib.crc32(str(k).encode()) % 5 == 0 for k in got.doc_id]).all()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() >= 0.97
    assert (held.predicted[held.quality == 0] == 0).mean() >= 0.9


def test_held_out_labels_and_other_columns_are_not_looked_at(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scores = []
    for name, d, l in (("a", docs, labels), ("b", docs.withColumn("lang", F.lit("x")).withColumn("score", F.lit("x")).repartition(3),
                                             labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))))):
        d.write.parquet(str(tmp_path / name / "documents.parquet"))
        l.write.parquet(str(tmp_path / name / "labels.parquet"))
        scores.append(sorted(map(tuple, op12_quality(spark, str(tmp_path / name)).collect())))
    assert scores[0] == scores[1]


def test_edge_rows_get_scores(spark, labelled, docs):
    model = quality.fit(labelled)
    rows = [(1, None), (2, ""), (3, "  "), (4, "word " * 60_000), (4, "word " * 60_000), (None, "A good line of words."), (5, "中文" * 9)]
    got = quality.score(quality.described(docs(rows, extra=True)), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[4]) == 1 and by[1] == by[2]
    assert quality.score(quality.described(docs([])), model).count() == 0


def test_labels_of_one_kind_or_none_give_no_model(spark, labelled, docs):
    assert quality.fit(labelled.where("label = 1")) is None and quality.fit(labelled.limit(0)) is None
    assert [r.score for r in quality.score(quality.described(docs([(1, "a")])), None).collect()] == [0.5]


def test_no_documents_and_no_labels(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert op12_quality(spark, str(tmp_path)).count() == 0


def test_invalid_utf8_is_read_with_replacements(spark):
    df = spark.sql("select 1L as doc_id, cast(x'FF20FE61' as string) as text")
    assert quality.score(quality.described(df), None).count() == 1
