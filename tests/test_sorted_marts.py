"""A global sort reads its input twice (to sample it, then to deal it out); an aggregation under it must not run twice."""

from tiermart.plans import registry

SF001 = "/root/testdata/sf0.001"


def test_customer_risk_is_dealt_out_between_its_aggregation_and_its_sort(spark):
    df = registry.gold_customer_risk(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    nodes = [line.lstrip(" :+-") for line in plan]
    ranged = next(i for i, n in enumerate(nodes) if n.startswith("Exchange rangepartitioning(loss_ratio_pct"))
    below = nodes[ranged + 1:]
    dealt = next(i for i, n in enumerate(below) if n.startswith("Exchange"))
    assert "REBALANCE" in below[dealt]
    assert not any("Aggregate" in n.split("(")[0] for n in below[:dealt])


def test_customer_risk_is_in_order_across_partitions(spark):
    df = registry.gold_customer_risk(spark, SF001)
    rows = [(r["loss_ratio_pct"], r["customer_id"]) for r in df.collect()]
    assert rows and rows == sorted(rows, key=lambda r: (-r[0], r[1]))
