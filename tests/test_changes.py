"""Snapshot difference, and tables brought up to date from it against full rebuilds."""

import random

import pytest
from pyspark.sql import functions as F

from tiermart.plans import gold, silver
from tiermart.sources import proxies
from tiermart.streaming import changes

SF = "/root/testdata/sf0.001"
ROW = "k long, l string, v double, s string, fetched_at string"


def by_key(rows):
    out = {}
    for k, l, v, s, _ in rows:
        out.setdefault((k, l), []).append((str(v), s))
    return {key: sorted(vs, key=str) for key, vs in out.items()}


def test_changed_keys_equal_a_comparison_row_by_row(spark):
    r = random.Random(6)

    def row():
        return (r.choice([None, 1, 2, 3, 4, 5, 6]), r.choice(["a", "b", None]), r.choice([None, 0.1, float("nan"), 2.0]), r.choice([None, "x", ""]), "old")
    for _ in range(6):
        old = [row() for _ in range(25)]
        new = [(*x[:4], "new") for x in old if r.random() < 0.7] + [row() for _ in range(8)]
        r.shuffle(new)
        a, b = by_key(old), by_key(new)
        want = {key: changes.NEW if key not in a else changes.GONE if key not in b else changes.CHANGED
                for key in a.keys() | b.keys() if a.get(key) != b.get(key)}
        got = changes.changed_keys(spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW).repartition(3), ["k", "l"])
        assert {(x.k, x.l): x.change for x in got.collect()} == want


def test_columns_go_by_name_and_stamps_do_not_count(spark):
    a = spark.createDataFrame([(1, "x", "m"), (2, "y", "m")], "k long, v string, fetched_at string")
    b = spark.createDataFrame([("n", "x", 1), ("n", "y", 2)], "fetched_at string, v string, k long")
    assert changes.changed_keys(a, b, ["k"]).count() == 0
    wider = b.withColumn("more", F.when(F.col("k") == 2, 1))
    assert [(r.k, r.change) for r in changes.changed_keys(a, wider, ["k"]).collect()] == [(2, changes.CHANGED)]
    assert changes.changed_keys(a, a.limit(0), ["k"]).count() == 2 and changes.changed_keys(a.limit(0), a.limit(0), ["k"]).count() == 0


def mutated(r, df, key):
    """Another snapshot: rows gone, changed and added, some keys repeated."""
    a, b = r.randint(2, 40), r.randint(2, 40)
    at = F.pmod(F.col(key), F.lit(41))
    money = {"claim_id": "claimed_amount", "policy_id": "premium", "customer_id": "credit_score"}[key]
    out = df.where(at != a).withColumn(money, F.when(at == b, F.col(money) + 3).otherwise(F.col(money)))
    return out.unionByName(out.where(at == 1)).unionByName(df.where(at == a).withColumn(key, F.col(key) + 10_000_000))


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_tables_equal_full_rebuilds(spark, scratch, seed):
    r = random.Random(seed)
    keys = {"customers": "customer_id", "policies": "policy_id", "claims": "claim_id"}

    def stored(df, name):
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")
    bronze = {t: stored(proxies.BUILDERS[t](spark, SF), f"b1/{t}") for t in keys}
    after = {t: stored(mutated(r, b, keys[t]) if seed == 2 or t == "claims" else b, f"b2/{t}") for t, b in bronze.items()}
    old = {t: stored(silver.clean(t, b, "x"), f"s1/{t}") for t, b in bronze.items()}
    found = {t: stored(changes.changed_keys(bronze[t], after[t], [keys[t]]), f"c/{t}") for t in keys}
    new = {}
    for t in keys:
        table, cleaned = changes.refresh_clean(t, old[t], after[t], found[t], [keys[t]], "x")
        new[t] = stored(table, f"s2/{t}")
        assert rows_of(new[t]) == rows_of(silver.clean(t, after[t], "x"))
        assert cleaned.count() <= 0.15 * after[t].count()
    assert found["claims"].count() > 0
    summary, built = changes.refresh_claims_summary(gold.claims_summary(old["claims"], "x"), old["claims"], new["claims"], found["claims"], "x")
    assert rows_of(summary) == rows_of(gold.claims_summary(new["claims"], "x")) and built.count() <= summary.count()
    mart = stored(gold.customer_risk_from_clean(*[old[t] for t in keys], "x"), "g1")
    risk, built = changes.refresh_customer_risk(mart, old, new, found, "x")
    assert rows_of(risk) == rows_of(gold.customer_risk_from_clean(*[new[t] for t in keys], "x"))
    assert built.count() < risk.count()


def test_nothing_changed_builds_nothing(spark):
    claims = silver.clean("claims", proxies.claims(spark, SF), "x")
    none = changes.changed_keys(claims, claims, ["claim_id"])
    mart = gold.claims_summary(claims, "x")
    same, built = changes.refresh_claims_summary(mart, claims, claims, none, "x")
    assert built.count() == 0 and rows_of(same) == rows_of(mart)
