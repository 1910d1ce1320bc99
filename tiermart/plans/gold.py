"""Gold layer: business marts.

Money is summed exactly in DECIMAL and rounded HALF_UP; ratios are taken
from the already-rounded totals (as the marts define them) with exact
integer arithmetic; outputs are doubles/longs. See ``functions.numeric``.

Scale notes (each mart is one lazy plan):
* Every group-by runs as partial (map-side) + final aggregation, so a hot
  group key never ships its raw rows through one task.
* Where a mart needs only sums over a one-to-many join (policy x claim,
  policy x payment), the many side is aggregated per policy *before* the
  join, and each policy row is re-weighted by its number of matches. The
  result equals aggregating the fanned-out rows (the reference's
  semantics), but the join sees at most one right row per key.
* Broadcast vs. shuffle join is left to adaptive execution, which decides
  from measured shuffle sizes (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
* Every final sort ends with the group key. Ties on the sort value (all
  claim-free customers have a loss ratio of 0) would otherwise land in one
  range partition, since a range partitioner cannot split equal keys; the
  tiebreaker lets it spread them, and makes the order deterministic.
* A sort reads its input twice, first to sample it. The mart with a row for each customer is dealt out before it is sorted, so
  that the second reading does not aggregate again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.functions.numeric import (
    EXACT,
    MONEY,
    div_half_up,
    mean_half_up,
    merge_special,
    money,
    n_unique,
    pct_half_up,
    pct_special,
    special,
    special_of,
    sum0,
    sum_exact,
    sum_money,
    with_special,
)
from tiermart.operators.frames import fill_numeric, stamp
from tiermart.operators.quality import validate


def claims_summary(claims: DataFrame, as_of: str) -> DataFrame:
    """G1: per (claim_type, status): counts, totals, means, approval rate."""
    validate(claims, ["claim_type", "status", "claimed_amount", "approved_amount"])
    agg = claims.groupBy("claim_type", "status").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.round(sum_money("claimed_amount"), 2).alias("_claimed"),
        F.round(sum_money("approved_amount"), 2).alias("_approved"),
        special("claimed_amount").alias("_claimed_bits"),
        special("approved_amount").alias("_approved_bits"),
        mean_half_up("claimed_amount", 2).alias("avg_claimed"),
        mean_half_up("approved_amount", 2).alias("avg_approved"),
    )
    out = agg.select(
        "claim_type", "status", "total_claims",
        with_special("_claimed_bits", "_claimed").alias("total_claimed"),
        with_special("_approved_bits", "_approved").alias("total_approved"),
        "avg_claimed", "avg_approved",
        pct_special("_approved_bits", "_approved", "_claimed_bits", "_claimed").alias("approval_rate_pct"),
    ).orderBy(F.col("claim_type").asc_nulls_first(), F.col("status").asc_nulls_first())
    return stamp(out, "aggregated_at", as_of)


def premium_revenue(policies: DataFrame, payments: DataFrame, as_of: str) -> DataFrame:
    """Completed payments INNER policies, per policy_type.

    Premium totals and means run over policy x payment rows (a policy with
    three completed payments counts its premium three times), while
    ``total_policies`` counts distinct policies.
    """
    validate(policies, ["policy_id", "policy_type", "premium"])
    validate(payments, ["policy_id", "amount", "status"])
    per_policy = (
        payments.where(F.col("status") == "Completed")
        .groupBy("policy_id")
        .agg(F.count(F.lit(1)).alias("_rows"),
             F.count("amount").alias("_amounts"),
             sum_money("amount").alias("_collected"),
             special("amount").alias("_collected_bits"))
    )
    rows = F.col("_rows")
    joined = policies.select("policy_id", "policy_type", "premium").join(per_policy, "policy_id", "inner")
    agg = joined.groupBy("policy_type").agg(
        n_unique("policy_id").alias("total_policies"),
        F.round(sum_exact(money("premium") * rows), 2).alias("_premium"),
        sum_exact(money("premium") * rows).alias("_premium_exact"),
        F.sum(F.when(F.col("premium").isNotNull(), rows)).alias("_premium_n"),
        F.round(F.sum("_collected"), 2).alias("_collected"),
        F.sum("_collected").alias("_collected_exact"),
        F.sum("_amounts").alias("_amount_n"),
        special("premium").alias("_premium_bits"),
        merge_special("_collected_bits").alias("_collected_bits"),
    )
    out = agg.select(
        "policy_type",
        F.col("total_policies").cast("long").alias("total_policies"),
        with_special("_premium_bits", "_premium").alias("total_premium"),
        F.when(F.col("_premium_n") > 0, with_special("_premium_bits", div_half_up("_premium_exact", "_premium_n", 2)))
        .alias("avg_premium"),
        with_special("_collected_bits", "_collected").alias("total_collected"),
        F.when(F.col("_amount_n") > 0, with_special("_collected_bits", div_half_up("_collected_exact", "_amount_n", 2)))
        .alias("avg_collection"),
        pct_special("_collected_bits", "_collected", "_premium_bits", "_premium").alias("collection_rate_pct"),
    ).orderBy(F.col("total_premium").desc_nulls_first(), F.col("policy_type").asc_nulls_first())
    return stamp(out, "aggregated_at", as_of)


def agent_performance(agents: DataFrame, policies: DataFrame, claims: DataFrame, as_of: str) -> DataFrame:
    """Policies LEFT claims per agent, then agents LEFT metrics, fill 0.

    ``total_policies`` and ``total_premium`` count policy x claim rows (a
    policy without claims counts once). Agents without policies get 0
    policies and a NaN claim rate (0/0).
    """
    validate(agents, ["agent_id", "first_name", "last_name", "region"])
    validate(policies, ["agent_id", "policy_id", "premium"])
    validate(claims, ["claim_id", "policy_id", "approved_amount"])
    per_policy = claims.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("claim_id").alias("_with_claim"),
        F.sum(money("approved_amount")).alias("_approved"),
        special("approved_amount").alias("_approved_bits"),
    )
    fan = F.greatest(F.coalesce(F.col("_rows"), F.lit(0)), F.lit(1))
    joined = policies.select("policy_id", "agent_id", "premium").join(per_policy, "policy_id", "left")
    metrics = joined.groupBy("agent_id").agg(
        sum0(fan).alias("total_policies"),
        sum0("_with_claim").alias("policies_with_claims"),
        F.round(sum_exact(money("premium") * fan), 2).alias("_premium"),
        F.round(F.coalesce(F.sum("_approved"), F.lit(0).cast(MONEY)), 2).alias("_claims_amount"),
        special("premium").alias("_premium_bits"),
        merge_special("_approved_bits").alias("_claims_bits"),
    )
    result = fill_numeric(agents.join(metrics, "agent_id", "left").select(*agents.columns, *metrics.columns[1:]))
    premium, rate = with_special("_premium_bits", "_premium"), F.col("commission_rate")
    # Exact where both factors are finite, else as doubles multiply.
    commission = F.when(
        F.col("_premium_bits").bitwiseOR(special_of(rate)) == 0,
        F.round(F.col("_premium").cast("decimal(20,2)") * F.when(special_of(rate) == 0, rate.cast("decimal(17,8)")), 2)
        .cast("double")).otherwise(premium * rate)
    out = result.select(
        *agents.columns,
        F.col("total_policies").cast("long").alias("total_policies"),
        F.col("policies_with_claims").cast("long").alias("policies_with_claims"),
        premium.alias("total_premium"),
        with_special("_claims_bits", "_claims_amount").alias("total_claims_amount"),
        commission.alias("commission_earned"),
        pct_half_up("policies_with_claims", "total_policies").alias("claim_rate_pct"),
    ).orderBy(F.col("total_premium").desc_nulls_first(), F.col("agent_id").asc_nulls_first())
    return stamp(out, "aggregated_at", as_of)


def customer_risk(customer_policies: DataFrame, policy_claims: DataFrame, as_of: str) -> DataFrame:
    """G4 from the two silver join tables (as the layered run stores them).

    Two-stage aggregation: the policy-claims table is reduced to one row per
    policy (partial aggregation map-side), so the join to customer-policies
    sees one right row per key and the per-customer aggregation is again
    partial + final.
    """
    validate(customer_policies, ["customer_id", "policy_id", "premium", "credit_score"])
    validate(policy_claims, ["policy_id", "has_claim", "claimed_amount"])
    per_policy = policy_claims.groupBy("policy_id").agg(
        F.count_if(F.col("has_claim")).alias("claim_count"),
        sum_money("claimed_amount").alias("total_claimed"),
        special("claimed_amount").alias("_claimed_bits"),
    )
    return _risk(customer_policies, per_policy, as_of)


def customer_risk_from_clean(customers: DataFrame, policies: DataFrame, claims: DataFrame, as_of: str) -> DataFrame:
    """G4 computed straight from the cleaned tables, without the fan-out table.

    Per policy id, the policy-claims table holds ``m x k`` rows, where ``m``
    is how often the id occurs among policies and ``k`` its number of
    claims (``k = 0`` gives ``m`` claim-less rows). So its per-policy claim
    count is ``m x count(claim_id)`` and its claimed total ``m x sum``. Both
    factors are partial aggregates (one small row per id), so no claim row
    and no hot policy ever crosses the shuffle whole; the result equals
    ``customer_risk(customer_policies, policy_claims)``.
    """
    from tiermart.plans.silver import customer_policies as join_customer_policies

    validate(claims, ["claim_id", "policy_id", "claimed_amount"])
    per_claimed_policy = claims.groupBy("policy_id").agg(
        F.count("claim_id").alias("_claims"), F.sum(money("claimed_amount")).alias("_claimed"),
        special("claimed_amount").alias("_claimed_bits"))
    multiplicity = policies.where(F.col("policy_id").isNotNull()).groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("_m"))
    per_policy = per_claimed_policy.join(multiplicity, "policy_id", "inner").select(
        "policy_id",
        (F.col("_claims") * F.col("_m")).alias("claim_count"),
        F.coalesce(F.col("_claimed") * F.col("_m"), F.lit(0).cast(MONEY)).alias("total_claimed"),
        "_claimed_bits",
    )
    cp = join_customer_policies(customers, policies, as_of, sort=False)
    return _risk(cp, per_policy, as_of)


def _risk(customer_policies: DataFrame, per_policy: DataFrame, as_of: str) -> DataFrame:
    risk = fill_numeric(
        customer_policies.select("customer_id", "policy_id", "premium", "credit_score")
        .join(per_policy, "policy_id", "left")
    )
    agg = risk.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_policies"),
        F.round(sum_money("premium"), 2).alias("_premium"),
        mean_half_up("credit_score", 0).alias("avg_credit_score"),
        sum0("claim_count").alias("total_claims"),
        F.round(F.sum(F.col("total_claimed").cast(EXACT)), 2).alias("_claimed"),
        special("premium").alias("_premium_bits"),
        merge_special("_claimed_bits").alias("_claimed_bits"),
    )
    loss = pct_special("_claimed_bits", "_claimed", "_premium_bits", "_premium")
    out = agg.select(
        "customer_id",
        F.col("total_policies").cast("long").alias("total_policies"),
        with_special("_premium_bits", "_premium").alias("total_premium"),
        "avg_credit_score",
        F.col("total_claims").cast("long").alias("total_claims"),
        with_special("_claimed_bits", "_claimed").alias("total_claimed_amount"),
        pct_half_up("total_claims", "total_policies").alias("claim_frequency_pct"),
        loss.alias("loss_ratio_pct"),
    )
    out = out.withColumn(
        "risk_category",
        F.when(F.col("loss_ratio_pct") > 50, "High").when(F.col("loss_ratio_pct") > 20, "Medium").otherwise("Low"),
    ).hint("rebalance").orderBy(F.col("loss_ratio_pct").desc_nulls_first(), F.col("customer_id").asc_nulls_first())
    return stamp(out, "aggregated_at", as_of)


def daily_metrics(events: DataFrame) -> DataFrame:
    """G5 (documented): per day, distinct users (null counts once) and events."""
    validate(events, ["user_id", "event_type"])
    dated = events if "date" in events.columns else events.withColumn("date", F.to_date("ts"))
    return (
        dated.groupBy("date")
        .agg(n_unique("user_id").alias("unique_users"), F.count("event_type").alias("total_events"))
        .orderBy(F.col("date").asc_nulls_first())
    )


def monthly_signups(users: DataFrame) -> DataFrame:
    """G6 (documented): per calendar month number (years merge, as defined)."""
    validate(users, ["user_id", "email", "created_at"])
    return (
        users.groupBy(F.month("created_at").alias("created_at"))
        .agg(n_unique("user_id").alias("monthly_users"), F.count("email").alias("total_signups"))
        .orderBy(F.col("created_at").asc_nulls_first())
    )


def daily_totals(df: DataFrame, key: str = "date", value: str = "amount") -> DataFrame:
    """Documented simple mart: per day, the total of a money column (exact sum,
    0 over nulls only, NaN and infinities as IEEE sums them, same column name), sorted by day."""
    validate(df, [key, value])
    return (df.groupBy(key).agg(with_special(special(value), sum_money(value)).alias(value))
            .orderBy(F.col(key).asc_nulls_first()))
