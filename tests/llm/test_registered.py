"""Every registered corpus query runs on tables that hold what its module defines a result for."""

import pytest
from pyspark.sql import functions as F

from tiermart.llm.queries import QUERIES

BAD = "cast(x'FF20C328205B0A6162630A' as string)"  # not UTF-8


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Given tables of the smallest size, and rows with null, empty and invalid texts, null and repeated ids."""
    root = tmp_path_factory.mktemp("tables")
    given = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{given}/documents.parquet")
    odd = spark.sql(f"""select * from values (9000000L, {BAD}), (9000001L, null), (9000002L, ''), (null, 'no id'), (null, null),
                        (9000003L, {BAD}), (9000003L, {BAD}), (9000004L, repeat('long words of one text ', 20000)) as t(doc_id, text)""").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.length("text").cast("long").alias("n_chars"))
    docs.unionByName(odd).withColumn("SIZE", F.lit("x")).write.parquet(f"{root}/documents.parquet")
    pages = spark.read.parquet(f"{given}/pages.parquet")
    pages.unionByName(spark.sql(f"select * from values (9000000L, 'u', {BAD}), (null, null, null) as t(page_id, url, html)")).write.parquet(
        f"{root}/pages.parquet")
    bench = spark.read.parquet(f"{given}/benchmark.parquet")
    bench.unionByName(bench.limit(1).withColumn("text", F.expr(BAD))).write.parquet(f"{root}/benchmark.parquet")
    labels = spark.read.parquet(f"{given}/labels.parquet")
    labels.unionByName(spark.sql("select * from values (9000000L, 1, 0), (9000001L, null, null), (null, 0, 1) as t(doc_id, quality, toxic)")).write.parquet(
        f"{root}/labels.parquet")
    turns = spark.read.parquet(f"{given}/conversations.parquet")
    turns.unionByName(spark.sql(f"select * from values (7L, null, 'user', {BAD}), (null, 1L, null, null) as t(conv_id, turn, role, text)")).write.parquet(
        f"{root}/conversations.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_odd_rows(spark, folder, name):
    got = QUERIES[name](spark, folder)
    n = got.count()
    table = "pages" if name == "op2_main_text" else "documents"
    if name not in ("op3_decontamination", "op13_prefix_trie"):
        assert n == spark.read.parquet(f"{folder}/{table}.parquet").count()
    assert n and got.columns == list(dict.fromkeys(got.columns))
