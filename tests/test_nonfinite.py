"""Infinities in money: as IEEE sums and divides them, in every mart, however the rows are pre-aggregated."""

import math

import pytest
from pyspark.sql import functions as F

from tiermart.functions.numeric import ieee_div, mean_half_up, merge_special, pct_special, special, sum_money, total_or_nan, with_special
from tiermart.plans import gold, silver
from tiermart.sources import proxies

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def same(a, b):
    return (a is None and b is None) or (a is not None and b is not None and (
        a == b and math.copysign(1, a) == math.copysign(1, b) or (math.isnan(a) and math.isnan(b))))


CASES = [[INF, 1.0], [-INF, 1.0, 2.0], [INF, -INF], [INF, INF], [NAN, INF], [NAN, 1.0], [1.0, 2.5], [INF], [None, -INF], [None], [0.1, 0.2]]


def test_totals_and_means_are_those_of_doubles(spark):
    df = spark.createDataFrame([(k, x) for k, xs in enumerate(CASES) for x in xs], "k int, x double")
    parts = df.withColumn("part", F.monotonically_increasing_id() % 3).groupBy("k", "part").agg(special("x").alias("bits"), sum_money("x").alias("s"))
    merged = {r.k: r.t for r in parts.groupBy("k").agg(with_special(merge_special("bits"), F.sum("s")).alias("t")).collect()}
    for r in df.groupBy("k").agg(total_or_nan("x").alias("t"), mean_half_up("x", 2).alias("m")).collect():
        xs = [x for x in CASES[r.k] if x is not None]
        want = round(math.fsum(xs), 2) if all(map(math.isfinite, xs)) else sum(xs)
        assert same(r.t, want) and same(merged[r.k], want), (CASES[r.k], r)
        assert same(r.m, (round(want / len(xs), 2) if math.isfinite(want) else want) if xs else None), (CASES[r.k], r)


def test_ratios_are_those_of_doubles(spark):
    values = [INF, -INF, NAN, 0.0, 2.0, -3.0]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(pairs, "a double, b double")

    def divided(a, b):
        if b == 0:
            return NAN if a == 0 or math.isnan(a) else math.copysign(INF, a)
        return a / b + 0.0
    for r in df.select("a", "b", ieee_div("a", "b").alias("q")).collect():
        assert same(r.q, divided(r.a, r.b)), r
    keyed = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "k int, a double, b double")
    sums = keyed.groupBy("k").agg(special("a").alias("ab"), sum_money("a").alias("a"), special("b").alias("bb"), sum_money("b").alias("b"))
    for r in sums.select("k", pct_special("ab", "a", "bb", "b").alias("p")).collect():
        want = divided(*pairs[r.k]) * 100
        assert same(r.p, round(want, 2) + 0.0 if math.isfinite(want) else want), (pairs[r.k], r)


@pytest.fixture(scope="module")
def clean(spark):
    return {t: silver.clean(t, b(spark, SF), "x") for t, b in proxies.BUILDERS.items()}


def spoil(df, key, column):
    """Some values infinite, some the other way, some NaN."""
    at = F.pmod(F.col(key), F.lit(29))
    return df.withColumn(column, F.when(at == 0, F.lit(INF)).when(at == 7, F.lit(-INF)).when(at == 11, F.lit(NAN)).otherwise(F.col(column)))


def total(values):
    xs = [v for v in values if v is not None]
    return sum(xs) if not all(map(math.isfinite, xs)) else None  # finite ones are checked elsewhere


def grouped(rows, key, value):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r[value])
    return out


def check(got, want):
    odd = 0
    for k, values in want.items():
        t = total(values)
        if k in got:
            assert same(got[k], t) if t is not None else math.isfinite(got[k]), (k, got[k], t)
            odd += t is not None
    assert odd


def test_claims_summary(spark, clean):
    claims = spoil(clean["claims"], "claim_id", "claimed_amount")
    got = gold.claims_summary(claims, "x").collect()
    want = grouped(claims.collect(), lambda r: (r.claim_type, r.status), "claimed_amount")
    check({(r.claim_type, r.status): r.total_claimed for r in got}, want)
    for r in got:
        if math.isinf(r.total_claimed):
            assert r.approval_rate_pct == 0 and r.avg_claimed == r.total_claimed
        elif math.isnan(r.total_claimed):
            assert math.isnan(r.approval_rate_pct) and math.isnan(r.avg_claimed)


def test_premium_revenue(spark, clean):
    paid = clean["payments"].where("status = 'Completed'")
    policies = spoil(clean["policies"], "policy_id", "premium").where("policy_id % 29 <> 11 and policy_id % 29 <> 7")
    rows = policies.join(paid, "policy_id").select("policy_type", "premium").collect()
    got = gold.premium_revenue(policies, clean["payments"], "x").collect()
    check({r.policy_type: r.total_premium for r in got}, grouped(rows, lambda r: r.policy_type, "premium"))
    assert all(r.collection_rate_pct == 0 for r in got if r.total_premium == INF) and any(r.total_premium == INF for r in got)
    spoiled = spoil(clean["payments"], "payment_id", "amount")
    rows = clean["policies"].join(spoiled.where("status = 'Completed'"), "policy_id").select("policy_type", "amount").collect()
    got = gold.premium_revenue(clean["policies"], spoiled, "x").collect()
    check({r.policy_type: r.total_collected for r in got}, grouped(rows, lambda r: r.policy_type, "amount"))


def test_agent_performance(spark, clean):
    policies = spoil(clean["policies"], "policy_id", "premium")
    claims = spoil(clean["claims"], "claim_id", "approved_amount")
    agents = clean["agents"].withColumn("commission_rate", F.when(F.col("agent_id") % 5 == 0, F.lit(0.0)).when(
        F.col("agent_id") % 7 == 0, F.lit(INF)).otherwise(F.col("commission_rate")))
    rows = policies.select("policy_id", "agent_id", "premium").join(claims.select("policy_id", "approved_amount"), "policy_id", "left").collect()
    got = gold.agent_performance(agents, policies, claims, "x").collect()
    check({r.agent_id: r.total_premium for r in got}, grouped(rows, lambda r: r.agent_id, "premium"))
    check({r.agent_id: r.total_claims_amount for r in got}, grouped(rows, lambda r: r.agent_id, "approved_amount"))
    for r in got:
        if not (math.isfinite(r.total_premium) and math.isfinite(r.commission_rate)):
            assert same(r.commission_earned, r.total_premium * r.commission_rate)
        else:
            assert math.isfinite(r.commission_earned)


@pytest.mark.parametrize("layered", [False, True])
def test_customer_risk(spark, clean, layered):
    claims = spoil(clean["claims"], "claim_id", "claimed_amount")
    policies = spoil(clean["policies"], "policy_id", "premium")
    cp = silver.customer_policies(clean["customers"], policies, "x", sort=False)
    pc = silver.policy_claims(policies, claims, "x", sort=False)
    got = (gold.customer_risk(cp, pc, "x") if layered else
           gold.customer_risk_from_clean(clean["customers"], policies, claims, "x")).collect()
    check({r.customer_id: r.total_premium for r in got}, grouped(cp.collect(), lambda r: r.customer_id, "premium"))
    rows = cp.select("customer_id", "policy_id").join(pc.select("policy_id", "claimed_amount"), "policy_id", "left").collect()
    check({r.customer_id: r.total_claimed_amount for r in got}, grouped(rows, lambda r: r.customer_id, "claimed_amount"))
    for r in got:
        if math.isinf(r.total_claimed_amount) and math.isfinite(r.total_premium):
            assert r.loss_ratio_pct == r.total_claimed_amount and r.risk_category == ("High" if r.loss_ratio_pct > 0 else "Low")


def test_daily_totals(spark):
    df = spark.createDataFrame([("a", INF), ("a", 1.0), ("b", 1.5), ("c", INF), ("c", -INF)], "date string, amount double")
    got = {r.date: r.amount for r in gold.daily_totals(df).collect()}
    assert got["a"] == INF and got["b"] == 1.5 and math.isnan(got["c"])


def test_whole_numbers_and_decimals_have_no_special_values(spark):
    df = spark.sql("select * from values (1, 1.25BD), (null, null) as t(i, d)")
    assert tuple(df.agg(special("i"), special("d"), total_or_nan("i"), total_or_nan("d")).first()) == (0, 0, 1.0, 1.25)
