"""A hot key on the many side: adaptive execution can split it only in the skew-tolerant join."""

import pytest
from pyspark.sql import functions as F

from tiermart.operators.joins import left_join_skew_safe, suffix_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _executed(df):
    rows = df.collect()  # runs this DataFrame's own adaptive plan
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_claim_key_is_split_only_by_the_skew_tolerant_join(spark, skew_conf):
    sf = "/root/testdata/sf0.01"
    # many map tasks, as many input files would give on a cluster
    policies = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("policy_id")).repartition(8)
    claims = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")).alias("policy_id"),
        "l_extendedprice").repartition(8)  # a third of all claims on policy 7
    plain_rows, plain_plan = _executed(suffix_join(policies, claims, "policy_id", "left"))
    safe_rows, safe_plan = _executed(left_join_skew_safe(policies, claims, "policy_id"))
    assert sorted(map(tuple, safe_rows), key=str) == sorted(map(tuple, plain_rows), key=str)
    assert "skew=true" in safe_plan
    assert "skew=true" not in plain_plan
