"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly against the driver's tables, without reusing any Spark
code: bronze proxies, cleaning rules, joins and marts are re-stated in SQL.
The marts are computed literally (fan-out joins, then aggregate), so they
also check the pre-aggregation rewrites used on the Spark side.

Exactness rules shared with the Spark side: money sums in DECIMAL, HALF_UP
rounding, means and ratios by integer arithmetic (HUGEINT).
"""

from __future__ import annotations

AS_OF = "2024-01-01T00:00:00+00:00"
N_AGENTS = 97
# Unicode White_Space, stated here on its own: single code points and ranges, by number.
UNICODE_WHITESPACE = "".join(chr(c) for low, high in (
    (9, 13), (32, 32), (133, 133), (160, 160), (5760, 5760), (8192, 8202), (8232, 8233), (8239, 8239), (8287, 8287),
    (12288, 12288)) for c in range(low, high + 1))

STAMP = f"'{AS_OF}'"


def ws_trim(x: str) -> str:
    return f"trim({x}, '{UNICODE_WHITESPACE}')"


def title(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), '[^\\p{L}\\p{N}]|[\\p{L}\\p{N}]+'), "
            "lambda w: upper(left(w, 1)) || substr(w, 2)), '')")


def round2(x: str, digits: int = 2) -> str:
    """Row-level HALF_UP rounding of a double on its decimal form."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def dsum(x: str) -> str:
    """Exact money sum (0 over nothing)."""
    return f"coalesce(sum(CAST({x} AS DECIMAL(24,6))), CAST(0 AS DECIMAL(38,6)))"


def half_up_ratio(num: str, den: str, digits: int) -> str:
    """round(num/den, digits) HALF_UP with num, den exact HUGEINT expressions."""
    scale = 10**digits
    return (f"(CASE WHEN ({den}) = 0 THEN (CASE WHEN ({num}) = 0 THEN 'NaN'::DOUBLE WHEN ({num}) > 0 "
            f"THEN 'Infinity'::DOUBLE ELSE '-Infinity'::DOUBLE END) "
            f"ELSE CAST(sign({num}) * sign({den}) * ((abs({num}) * {2 * scale} + abs({den})) // (2 * abs({den})))"
            f" AS DOUBLE) / CAST({scale} AS DOUBLE) END)")


def mean(x: str, digits: int) -> str:
    k = f"CAST(sum(CAST({x} AS DECIMAL(24,6))) * 1000000 AS HUGEINT)"
    n = f"(CAST(count({x}) AS HUGEINT) * 1000000)"
    return f"(CASE WHEN count({x}) = 0 THEN NULL ELSE {half_up_ratio(k, n, digits)} END)"


def pct(a: str, b: str, scaled_by: int = 100) -> str:
    """round(a/b*100, 2) for exact a, b with ``scaled_by`` = 10^scale (100 for cents)."""
    return half_up_ratio(f"(CAST(({a}) * {scaled_by} AS HUGEINT) * 100)", f"CAST(({b}) * {scaled_by} AS HUGEINT)", 2)


# ---------------------------------------------------------------- bronze proxies
BRONZE = {
    "bronze_policies": f"""
SELECT o_orderkey AS policy_id,
       ' pol-' || CAST(o_orderkey AS VARCHAR) || ' ' AS policy_number,
       CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 83 <> 0 THEN o_orderkey % {N_AGENTS} END AS agent_id,
       lower(o_orderpriority) || chr(9) AS policy_type,
       ' ' || o_orderstatus || ' ' AS coverage_type,
       CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + CAST(0.004 AS DOUBLE) ELSE o_totalprice END AS premium,
       CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice * CAST(10 AS DOUBLE) END AS coverage_amount,
       CAST(100 * (1 + o_orderkey % 6) AS BIGINT) AS deductible,
       o_orderdate AS start_date,
       o_orderdate + INTERVAL 365 DAY AS end_date,
       o_orderstatus AS status,
       {STAMP} AS fetched_at
FROM orders""",
    "bronze_claims": f"""
SELECT l_orderkey * 8 + l_linenumber AS claim_id,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 101 <> 0 THEN l_orderkey END AS policy_id,
       'clm-' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS claim_number,
       ' ' || lower(l_linestatus) || CASE l_linenumber % 3 WHEN 0 THEN '-line ' WHEN 1 THEN '''line ' ELSE ' line ' END
           || CAST(l_linenumber AS VARCHAR) AS claim_type,
       l_shipdate AS incident_date,
       l_shipdate + INTERVAL 3 DAY AS reported_date,
       CASE WHEN l_discount = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS claimed_amount,
       CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_partkey % 5 = 0 THEN CAST(0 AS DOUBLE)
            ELSE l_extendedprice * CAST(0.75 AS DOUBLE) END AS approved_amount,
       l_linestatus || CAST(l_partkey % 5 AS VARCHAR) AS status,
       'line ' || CAST(l_linenumber AS VARCHAR) || ' of order ' || CAST(l_orderkey AS VARCHAR) AS description,
       {STAMP} AS fetched_at
FROM lineitem WHERE l_returnflag = 'R'""",
    "bronze_payments": f"""
SELECT l_orderkey * 8 + l_linenumber AS payment_id,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 103 <> 0 THEN l_orderkey END AS policy_id,
       ' pay-' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS payment_number,
       l_shipdate AS payment_date,
       CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE
            CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
            + CAST(0.003 AS DECIMAL(4,3)) AS DOUBLE) END AS amount,
       'way-' || lower(l_linestatus) || CAST(l_suppkey % 4 AS VARCHAR) || ' ' AS payment_method,
       CASE WHEN l_returnflag = 'A' AND l_orderkey % 23 = 0 THEN 'completed'
            WHEN l_returnflag = 'A' THEN 'Completed'
            ELSE 'Step ' || CAST(l_linenumber % 3 AS VARCHAR) END AS status,
       'txn-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
       ' ref' || CAST(l_partkey AS VARCHAR) AS reference_number,
       {STAMP} AS fetched_at
FROM lineitem WHERE l_returnflag <> 'R'""",
    "bronze_customers": f"""
SELECT c_custkey AS customer_id,
       '  ' || lower(c_name) AS first_name,
       lower(n_name) || chr(9) AS last_name,
       DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS date_of_birth,
       CASE WHEN c_custkey % 17 = 0 THEN 'customer' || CAST(c_custkey AS VARCHAR) || '.example.com'
            WHEN c_custkey % 19 = 0 THEN NULL
            ELSE ' Customer' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
       '+1 (555) ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
       CAST(c_custkey AS VARCHAR) || ' Main St' AS address,
       lower(n_name) AS city,
       ' ' || lower(substr(r_name, 1, 2)) AS state,
       ' ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || ' ' AS zip_code,
       lower(c_mktsegment) || CASE c_custkey % 3 WHEN 0 THEN '-hand ' WHEN 1 THEN ' o''hara' ELSE ' ' END AS occupation,
       CAST(30000 AS DOUBLE) + c_acctbal * CAST(10 AS DOUBLE) AS annual_income,
       CAST(280 + (c_custkey * 7) % 600 AS BIGINT) AS credit_score,
       TIMESTAMP '2019-01-01 00:00:00' + CAST(c_custkey % 1800 AS INTEGER) * INTERVAL 1 DAY AS join_date,
       {STAMP} AS fetched_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "bronze_agents": f"""
SELECT CASE WHEN s_suppkey % 31 <> 0 THEN s_suppkey END AS agent_id,
       lower(s_name) AS first_name,
       ' ' || lower(n_name) AS last_name,
       ' Agent' || CAST(s_suppkey AS VARCHAR) || '@Agency.Example ' AS email,
       '(555) 01-' || CAST(s_suppkey AS VARCHAR) AS phone,
       lower(r_name) AS region,
       lower(r_name) || '-' || CAST(s_suppkey % 5 AS VARCHAR) AS specialty,
       'lic-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS license_number,
       CASE WHEN s_suppkey % 29 = 0 THEN NULL
            ELSE CAST(5 + s_suppkey % 11 AS DOUBLE) / CAST(100 AS DOUBLE) END AS commission_rate,
       TIMESTAMP '2010-01-01 00:00:00' + CAST(s_suppkey % 3000 AS INTEGER) * INTERVAL 1 DAY AS hire_date,
       'Grade ' || CAST(s_suppkey % 3 AS VARCHAR) AS status,
       {STAMP} AS fetched_at
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "bronze_vehicles": f"""
SELECT p_partkey AS vehicle_id,
       p_partkey AS policy_id,
       substr(md5(CAST(p_partkey AS VARCHAR)), 1, 17) AS vin,
       lower(p_brand) AS make,
       p_name || ' ' AS model,
       CAST(1980 + p_size AS BIGINT) AS year,
       lower(p_type) AS vehicle_type,
       split_part(p_name, ' ', 1) AS color,
       CAST(p_size * 3000 AS BIGINT) AS mileage,
       lower(p_type) || '-' || CAST(p_partkey % 4 AS VARCHAR) AS engine_type,
       ' ' || lower(substr(p_type, 1, 2)) AS registration_state,
       DATE '2025-01-01' + p_size AS registration_expiry,
       {STAMP} AS fetched_at
FROM part""",
}

# ---------------------------------------------------------------- silver cleaning
T, U, L = (lambda c: title(ws_trim(c))), (lambda c: f"upper({ws_trim(c)})"), (lambda c: ws_trim(f"lower({c})"))
DIG = lambda c: ws_trim(f"regexp_replace({c}, '[^\\p{{Nd}}]', '', 'g')")

SILVER = {
    "silver_customers": f"""
SELECT * FROM (
  SELECT customer_id, {T('first_name')} AS first_name, {T('last_name')} AS last_name,
         CAST(date_of_birth AS DATE) AS date_of_birth, {L('email')} AS email, {DIG('phone')} AS phone,
         address, {T('city')} AS city, {U('state')} AS state, {ws_trim('zip_code')} AS zip_code,
         {T('occupation')} AS occupation, CAST(annual_income AS DOUBLE) AS annual_income,
         CAST(credit_score AS INTEGER) AS credit_score, CAST(join_date AS TIMESTAMP) AS join_date,
         fetched_at, {STAMP} AS transformed_at
  FROM bronze_customers)
WHERE contains(email, '@') AND credit_score >= 300 AND credit_score <= 850""",
    "silver_policies": f"""
SELECT * FROM (
  SELECT policy_id, {U('policy_number')} AS policy_number, customer_id, agent_id,
         {T('policy_type')} AS policy_type, {ws_trim('coverage_type')} AS coverage_type,
         {round2('premium')} AS premium, CAST(coverage_amount AS DOUBLE) AS coverage_amount,
         CAST(deductible AS INTEGER) AS deductible, start_date, end_date, status, fetched_at,
         {STAMP} AS transformed_at
  FROM bronze_policies)
WHERE premium > 0 AND coverage_amount > 0 AND customer_id IS NOT NULL AND agent_id IS NOT NULL""",
    "silver_claims": f"""
SELECT claim_id, policy_id, claim_number, claim_type, incident_date, reported_date, claimed_amount,
       coalesce(approved_amount, CAST(0 AS DOUBLE)) AS approved_amount, status, description, fetched_at,
       transformed_at
FROM (
  SELECT claim_id, policy_id, {U('claim_number')} AS claim_number, {T('claim_type')} AS claim_type,
         incident_date, reported_date, {round2('claimed_amount')} AS claimed_amount,
         CAST(approved_amount AS DOUBLE) AS approved_amount, status, description, fetched_at,
         {STAMP} AS transformed_at
  FROM bronze_claims)
WHERE claimed_amount > 0 AND policy_id IS NOT NULL""",
    "silver_vehicles": f"""
SELECT * FROM (
  SELECT vehicle_id, policy_id, {U('vin')} AS vin, {T('make')} AS make, {T('model')} AS model,
         CAST(year AS INTEGER) AS year, {T('vehicle_type')} AS vehicle_type, {T('color')} AS color,
         CAST(mileage AS INTEGER) AS mileage, {T('engine_type')} AS engine_type,
         {U('registration_state')} AS registration_state, CAST(registration_expiry AS DATE) AS registration_expiry,
         fetched_at, {STAMP} AS transformed_at
  FROM bronze_vehicles)
WHERE year >= 1990 AND year <= 2025""",
    "silver_agents": f"""
SELECT agent_id, {T('first_name')} AS first_name, {T('last_name')} AS last_name, {L('email')} AS email,
       {DIG('phone')} AS phone, {T('region')} AS region, {T('specialty')} AS specialty,
       {U('license_number')} AS license_number, CAST(commission_rate AS DOUBLE) AS commission_rate,
       CAST(hire_date AS DATE) AS hire_date, status, fetched_at, {STAMP} AS transformed_at
FROM bronze_agents WHERE agent_id IS NOT NULL""",
    "silver_payments": f"""
SELECT * FROM (
  SELECT payment_id, policy_id, {U('payment_number')} AS payment_number, payment_date,
         {round2('amount')} AS amount, {T('payment_method')} AS payment_method, status,
         {U('transaction_id')} AS transaction_id, {U('reference_number')} AS reference_number,
         fetched_at, {STAMP} AS transformed_at
  FROM bronze_payments)
WHERE policy_id IS NOT NULL AND amount <> 0""",
}

CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "date_of_birth", "email", "phone", "address", "city",
                 "state", "zip_code", "occupation", "annual_income", "credit_score", "join_date", "fetched_at",
                 "transformed_at"]
POLICY_COLS = ["policy_id", "policy_number", "customer_id", "agent_id", "policy_type", "coverage_type", "premium",
               "coverage_amount", "deductible", "start_date", "end_date", "status", "fetched_at", "transformed_at"]
CLAIM_COLS = ["claim_id", "policy_id", "claim_number", "claim_type", "incident_date", "reported_date",
              "claimed_amount", "approved_amount", "status", "description", "fetched_at", "transformed_at"]
AGENT_COLS = ["agent_id", "first_name", "last_name", "email", "phone", "region", "specialty", "license_number",
              "commission_rate", "hire_date", "status", "fetched_at", "transformed_at"]


def _right(cols, left_cols, key, alias):
    return [f"{alias}.{c} AS {c + '_right' if c in left_cols else c}" for c in cols if c != key]


JOINED = {
    "silver_customer_policies": "SELECT " + ", ".join(
        [f"c.{x}" for x in CUSTOMER_COLS] + _right(POLICY_COLS, CUSTOMER_COLS, "customer_id", "p"))
    + " FROM silver_customers c JOIN silver_policies p ON c.customer_id = p.customer_id",
    "silver_policy_claims": "SELECT " + ", ".join(
        [f"p.{x}" for x in POLICY_COLS] + _right(CLAIM_COLS, POLICY_COLS, "policy_id", "c")
        + ["c.claim_id IS NOT NULL AS has_claim"])
    + " FROM silver_policies p LEFT JOIN silver_claims c ON p.policy_id = c.policy_id",
}


def _with(*names: str) -> str:
    """WITH clause holding the named CTEs (and what they depend on)."""
    order = list(BRONZE) + list(SILVER) + list(JOINED)
    deps = {
        "silver_customers": ["bronze_customers"], "silver_policies": ["bronze_policies"],
        "silver_claims": ["bronze_claims"], "silver_vehicles": ["bronze_vehicles"],
        "silver_agents": ["bronze_agents"], "silver_payments": ["bronze_payments"],
        "silver_customer_policies": ["silver_customers", "silver_policies"],
        "silver_policy_claims": ["silver_policies", "silver_claims"],
    }
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in deps.get(n, []):
            add(d)

    for n in names:
        add(n)
    body = {**BRONZE, **SILVER, **JOINED}
    return "WITH " + ",\n".join(f"{n} AS ({body[n]})" for n in order if n in need) + "\n"


# ---------------------------------------------------------------- gold marts
GOLD_CLAIMS_SUMMARY = _with("silver_claims") + f"""
, g AS (
  SELECT claim_type, status, count(*) AS total_claims,
         round({dsum('claimed_amount')}, 2) AS tc, round({dsum('approved_amount')}, 2) AS ta,
         {mean('claimed_amount', 2)} AS avg_claimed, {mean('approved_amount', 2)} AS avg_approved
  FROM silver_claims GROUP BY claim_type, status)
SELECT claim_type, status, total_claims, CAST(tc AS DOUBLE) AS total_claimed, CAST(ta AS DOUBLE) AS total_approved,
       avg_claimed, avg_approved, {pct('ta', 'tc')} AS approval_rate_pct, {STAMP} AS aggregated_at
FROM g"""

GOLD_PREMIUM_REVENUE = _with("silver_policies", "silver_payments") + f"""
, pp AS (
  SELECT p.policy_id, p.policy_type, p.premium, y.amount
  FROM silver_policies p JOIN (SELECT * FROM silver_payments WHERE status = 'Completed') y
       ON p.policy_id = y.policy_id)
, g AS (
  SELECT policy_type, count(DISTINCT policy_id) AS total_policies,
         round({dsum('premium')}, 2) AS tp, {mean('premium', 2)} AS avg_premium,
         round({dsum('amount')}, 2) AS tc, {mean('amount', 2)} AS avg_collection
  FROM pp GROUP BY policy_type)
SELECT policy_type, total_policies, CAST(tp AS DOUBLE) AS total_premium, avg_premium,
       CAST(tc AS DOUBLE) AS total_collected, avg_collection, {pct('tc', 'tp')} AS collection_rate_pct,
       {STAMP} AS aggregated_at
FROM g"""

_agent_out = [c if c != "commission_rate" else "coalesce(a.commission_rate, CAST(0 AS DOUBLE)) AS commission_rate"
              for c in AGENT_COLS]
GOLD_AGENT_PERFORMANCE = _with("silver_agents", "silver_policies", "silver_claims") + f"""
, pc AS (
  SELECT p.agent_id, p.premium, c.claim_id, c.approved_amount
  FROM silver_policies p LEFT JOIN silver_claims c ON p.policy_id = c.policy_id)
, m AS (
  SELECT agent_id, count(*) AS total_policies, count(claim_id) AS policies_with_claims,
         round({dsum('premium')}, 2) AS tp, round({dsum('approved_amount')}, 2) AS tca
  FROM pc GROUP BY agent_id)
, r AS (
  SELECT {', '.join(('a.' + c) if not c.startswith('coalesce') else c for c in _agent_out)},
         coalesce(m.total_policies, 0) AS total_policies, coalesce(m.policies_with_claims, 0) AS policies_with_claims,
         coalesce(m.tp, 0) AS tp, coalesce(m.tca, 0) AS tca
  FROM silver_agents a LEFT JOIN m ON a.agent_id = m.agent_id)
SELECT {', '.join(AGENT_COLS)}, total_policies, policies_with_claims,
       CAST(tp AS DOUBLE) AS total_premium, CAST(tca AS DOUBLE) AS total_claims_amount,
       CAST(round(CAST(tp AS DECIMAL(20,2)) * CAST(commission_rate AS DECIMAL(17,8)), 2) AS DOUBLE) AS commission_earned,
       {pct('policies_with_claims', 'total_policies', 1)} AS claim_rate_pct,
       {STAMP} AS aggregated_at
FROM r"""

GOLD_CUSTOMER_RISK = _with("silver_customer_policies", "silver_policy_claims") + f"""
, per_policy AS (
  SELECT policy_id, count(*) FILTER (WHERE has_claim) AS claim_count,
         {dsum('claimed_amount')} AS total_claimed
  FROM silver_policy_claims GROUP BY policy_id)
, r AS (
  SELECT cp.customer_id, cp.premium, cp.credit_score,
         coalesce(pp.claim_count, 0) AS claim_count, coalesce(pp.total_claimed, 0) AS total_claimed
  FROM silver_customer_policies cp LEFT JOIN per_policy pp ON cp.policy_id = pp.policy_id)
, g AS (
  SELECT customer_id, count(*) AS total_policies, round({dsum('premium')}, 2) AS tp,
         {mean('credit_score', 0)} AS avg_credit_score, sum(claim_count) AS total_claims,
         round(sum(total_claimed), 2) AS tcl
  FROM r GROUP BY customer_id)
, o AS (
  SELECT customer_id, total_policies, CAST(tp AS DOUBLE) AS total_premium, avg_credit_score,
         CAST(total_claims AS BIGINT) AS total_claims, CAST(tcl AS DOUBLE) AS total_claimed_amount,
         {pct('total_claims', 'total_policies', 1)} AS claim_frequency_pct,
         {pct('tcl', 'tp')} AS loss_ratio_pct
  FROM g)
SELECT *, CASE WHEN loss_ratio_pct > 50 THEN 'High' WHEN loss_ratio_pct > 20 THEN 'Medium' ELSE 'Low' END
          AS risk_category, {STAMP} AS aggregated_at
FROM o"""

USERS = """
SELECT c_custkey AS user_id,
       CASE WHEN c_custkey % 17 = 0 THEN 'customer' || CAST(c_custkey AS VARCHAR) || '.example.com'
            WHEN c_custkey % 19 = 0 THEN NULL
            ELSE ' Customer' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
       strftime(TIMESTAMP '2019-01-01 00:00:00' + CAST(c_custkey % 1800 AS INTEGER) * INTERVAL 1 DAY, '%Y-%m-%d')
         AS created_at
FROM customer"""

CLEAN_USERS = f"""
SELECT user_id, lower(email) AS email, strptime(created_at, '%Y-%m-%d') AS created_at
FROM ({USERS}) WHERE email IS NOT NULL"""

RAW_EVENTS = """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
       CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'User' || CAST(user_id AS VARCHAR) || '@Mail.Example' END AS email
FROM events"""


def _n_unique(c: str) -> str:
    return f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"


def _silver(name: str) -> str:
    return _with(name) + f"SELECT * FROM {name}"


ORACLE: dict[str, str] = {
    "clean_customers": _silver("silver_customers"),
    "clean_policies": _silver("silver_policies"),
    "clean_claims": _silver("silver_claims"),
    "clean_vehicles": _silver("silver_vehicles"),
    "clean_agents": _silver("silver_agents"),
    "clean_payments": _silver("silver_payments"),
    "silver_customer_policies": _with("silver_customer_policies")
    + f"SELECT * REPLACE ({STAMP} AS transformed_at) FROM silver_customer_policies",
    "silver_policy_claims": _with("silver_policy_claims")
    + f"SELECT * REPLACE ({STAMP} AS transformed_at) FROM silver_policy_claims",
    "gold_claims_summary": GOLD_CLAIMS_SUMMARY,
    "gold_premium_revenue": GOLD_PREMIUM_REVENUE,
    "gold_agent_performance": GOLD_AGENT_PERFORMANCE,
    "gold_customer_risk": GOLD_CUSTOMER_RISK,
    "gold_customer_risk_layered": GOLD_CUSTOMER_RISK,
    "daily_metrics": f"""
SELECT CAST(ts AS DATE) AS date, {_n_unique('uid')} AS unique_users, count(event_type) AS total_events
FROM (SELECT *, CASE WHEN user_id % 53 <> 0 THEN user_id END AS uid FROM events) GROUP BY CAST(ts AS DATE)""",
    "clean_users": CLEAN_USERS,
    "monthly_signups": f"""
SELECT CAST(month(created_at) AS INTEGER) AS created_at, {_n_unique('user_id')} AS monthly_users,
       count(email) AS total_signups
FROM ({CLEAN_USERS}) GROUP BY month(created_at)""",
    "validated_events": f"""
SELECT user_id, event_type, strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, lower(email) AS email
FROM (SELECT DISTINCT * FROM ({RAW_EVENTS})
      WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND timestamp IS NOT NULL AND email IS NOT NULL)""",
    "validated_orders": """
SELECT o_orderkey AS order_id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE o_totalprice > 0""",
    "daily_amount": f"""
SELECT CAST(o_orderdate AS DATE) AS date, CAST({dsum('o_totalprice')} AS DOUBLE) AS amount
FROM orders WHERE o_totalprice > 0 GROUP BY CAST(o_orderdate AS DATE)""",
    "join_suffix": """
SELECT o.o_custkey AS custkey, o.o_orderkey, o.o_orderstatus AS status, c.c_mktsegment AS status_right, c.c_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "fill_numeric": _with("silver_agents", "silver_policies") + """
SELECT a.agent_id, a.first_name, coalesce(a.commission_rate, CAST(0 AS DOUBLE)) AS commission_rate,
       coalesce(p.policies, 0) AS policies
FROM silver_agents a LEFT JOIN (SELECT agent_id, count(*) AS policies FROM silver_policies GROUP BY agent_id) p
     ON a.agent_id = p.agent_id""",
    "sum_empty_group": _with("silver_policy_claims") + f"""
SELECT policy_id, CAST(round({dsum('claimed_amount')}, 2) AS DOUBLE) AS total_claimed, count(claim_id) AS claims
FROM silver_policy_claims GROUP BY policy_id""",
    "sort_desc_nulls_first": _with("bronze_claims")
    + "SELECT claim_id, approved_amount FROM bronze_claims ORDER BY approved_amount DESC NULLS FIRST",
    "distinct_rows": "SELECT DISTINCT CAST(ts AS DATE) AS day, user_id, event_type FROM events",
    "drop_nulls_subset": f"SELECT * FROM ({USERS}) WHERE email IS NOT NULL",
}

ORACLE["zero_ratio"] = (GOLD_AGENT_PERFORMANCE.rsplit("SELECT " + ", ".join(AGENT_COLS), 1)[0]
                        + f"SELECT agent_id, total_policies, {pct('policies_with_claims', 'total_policies', 1)}"
                          " AS claim_rate_pct FROM r")

_profile_cols = [("claim_id", "bigint"), ("policy_id", "bigint"), ("claim_number", "string"),
                 ("claim_type", "string"), ("incident_date", "timestamp_ntz"), ("reported_date", "timestamp_ntz"),
                 ("claimed_amount", "double"), ("approved_amount", "double"), ("status", "string"),
                 ("description", "string"), ("fetched_at", "string"), ("transformed_at", "string")]
ORACLE["profile_output"] = _with("silver_claims") + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS type, count(*) AS rows, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM silver_claims"
    for i, (c, t) in enumerate(_profile_cols)
)

_ranged = {"claim_id", "policy_id", "incident_date", "reported_date", "claimed_amount", "approved_amount"}
ORACLE["stored_statistics"] = _with("silver_claims") + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS type, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    + (f"CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most" if c in _ranged
       else "CAST(NULL AS VARCHAR) AS least, CAST(NULL AS VARCHAR) AS most") + " FROM silver_claims"
    for i, (c, t) in enumerate(_profile_cols)
)
ORACLE["sorted_output_check"] = _with("silver_customer_policies", "silver_policy_claims") + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 0 AS inversions, 0 AS overlaps, count(*) AS rows FROM silver_{t}"
    for t in ("customer_policies", "policy_claims"))

# Steps that do not read customers are made by the first run; the others wait for the third.
_marts = {"claims_summary": GOLD_CLAIMS_SUMMARY, "premium_revenue": GOLD_PREMIUM_REVENUE,
          "agent_performance": GOLD_AGENT_PERFORMANCE, "customer_risk": GOLD_CUSTOMER_RISK,
          "policy_claims": _with("silver_policy_claims") + "SELECT * FROM silver_policy_claims",
          "customer_policies": _with("silver_customer_policies") + "SELECT * FROM silver_customer_policies"}
_late = {"customer_policies": "rejected", "customer_risk": "blocked"}
ORACLE["propagate_partial"] = "\nUNION ALL\n".join(
    f"SELECT {run} AS run, '{step}' AS step, '{_late[step]}' AS status, 0 AS table_rows" if step in _late and run < 3 else
    f"SELECT {run} AS run, '{step}' AS step, '{'made' if run == (3 if step in _late else 1) else 'current'}' AS status, "
    f"count(*) AS table_rows FROM ({sql})" for run in (1, 2, 3) for step, sql in _marts.items())

KEYS = {"customers": "customer_id", "policies": "policy_id", "claims": "claim_id", "vehicles": "vehicle_id",
        "agents": "agent_id", "payments": "payment_id"}
COLUMN_COUNTS = {"customers": 15, "policies": 13, "claims": 11, "vehicles": 13, "agents": 12, "payments": 10}

ORACLE.update({
    "read_latest_snapshot": ORACLE["clean_claims"],
    "sample_copy": _with("silver_payments")
    + "SELECT least(count(*), 50) AS sample_rows, least(count(*), 50) AS subset_rows FROM silver_payments",
    "fallback_write": ORACLE["clean_payments"],
    **{f"ingest_{'csv' if t == 'claims' else t}": _with(f"bronze_{t}") + f"""
SELECT *, 'say "hi", ' || CAST({key} AS VARCHAR) || {'chr(10) || ' + "'next'" if t in ('claims', 'vehicles') else "''"} AS note
FROM bronze_{t}""" for t, key in KEYS.items()},
    "ingest_json_flat": _with("bronze_customers") + """
SELECT customer_id, first_name AS "name.first", last_name AS "name.last", email AS "contact.email",
       phone AS "contact.phone", city AS "contact.address.city", state AS "contact.address.state",
       zip_code AS "contact.address.zip", annual_income
FROM bronze_customers""",
    "ingest_mixed_files": _with("bronze_policies") + """
SELECT f.format, CASE WHEN policy_id % 3 = 2 THEN 'see "' || policy_number || '", page 1' END AS note,
       * EXCLUDE (format, deductible), CASE WHEN policy_id % 3 <> 1 THEN deductible END AS deductible
FROM bronze_policies CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) f(format)""",
    "ingest_json_sparse": _with("silver_claims") + """
SELECT * REPLACE (CAST(0 AS DOUBLE) AS approved_amount, CAST(NULL AS VARCHAR) AS description),
       CASE WHEN claim_id % 7 = 0 THEN 'clm-' || CAST(claim_id AS VARCHAR) END AS audit_by,
       CASE WHEN claim_id % 7 = 0 THEN claim_id END AS audit_entry_nr
FROM silver_claims""",
    "incremental_clean": ORACLE["clean_claims"],
    "run_layers_customer_risk": GOLD_CUSTOMER_RISK,
    "run_layers_claims_summary": GOLD_CLAIMS_SUMMARY,
    "run_layers_premium_revenue": GOLD_PREMIUM_REVENUE,
    "run_layers_agent_performance": GOLD_AGENT_PERFORMANCE,
    **{f"run_layers_clean_{t}": ORACLE[f"clean_{t}"] for t in KEYS},
    "validate_steps": _with(*[f"bronze_{t}" for t in KEYS]) + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS row_count, {n} AS column_count, true AS empty_batch_refused, "
        f"true AS empty_frame_refused, true AS missing_column_refused FROM bronze_{t}" for t, n in COLUMN_COUNTS.items()),
    "sum_nan_group": _with("bronze_claims") + f"""
, x AS (SELECT CAST(incident_date AS DATE) AS day, claimed_amount AS amount, claim_id % 1009 = 0 AS broken
        FROM bronze_claims)
SELECT day, CASE WHEN bool_or(broken) THEN CAST('NaN' AS DOUBLE) ELSE CAST(round({dsum('amount')}, 2) AS DOUBLE) END AS total,
       CASE WHEN bool_or(broken) THEN CAST('NaN' AS DOUBLE) ELSE {mean('amount', 2)} END AS mean
FROM x GROUP BY day""",
    "sum_nonfinite_group": _with("bronze_claims") + f"""
, x AS (SELECT CAST(incident_date AS DATE) AS day, claim_id % 1999 AS odd, claimed_amount, approved_amount FROM bronze_claims)
, y AS (SELECT day, CASE WHEN odd > 6 THEN claimed_amount END AS amount, odd < 7 AS gone,
               CASE WHEN odd NOT IN (1, 7) THEN approved_amount END AS approved, odd IN (1, 7) AS up,
               odd < 3 AS plus, odd BETWEEN 3 AND 5 AS minus, odd = 6 AS nan FROM x)
, g AS (SELECT day, round({dsum('amount')}, 2) AS exact, round({dsum('approved')}, 2) AS approved, bool_or(up) AS up,
               {mean('amount', 2)} AS exact_mean, count(amount) + count(*) FILTER (WHERE gone) AS n,
               bool_or(nan) OR (bool_or(plus) AND bool_or(minus)) AS is_nan, bool_or(plus) AS plus, bool_or(minus) AS minus
        FROM y GROUP BY day)
, v AS (SELECT *, CASE WHEN is_nan THEN 'NaN'::DOUBLE WHEN plus THEN 'Infinity'::DOUBLE WHEN minus THEN '-Infinity'::DOUBLE END AS odd_value
        FROM g)
SELECT day, coalesce(odd_value, CAST(exact AS DOUBLE)) AS total, coalesce(odd_value, exact_mean) AS mean,
       CASE WHEN odd_value IS NULL AND NOT up THEN {pct('approved', 'exact')}
            WHEN is_nan OR (up AND odd_value IS NOT NULL) THEN 'NaN'::DOUBLE
            WHEN up THEN 'Infinity'::DOUBLE
            ELSE CAST(0 AS DOUBLE) END AS approved_pct
FROM v""",
    "incremental_propagate": GOLD_CUSTOMER_RISK,
})

ORACLE.update({
    "incremental_changed_groups": GOLD_CLAIMS_SUMMARY,
    "incremental_changed_customers": GOLD_CUSTOMER_RISK,
    # By claim id, which several lines of an order may share; every one of its rows changes, or none.
    "snapshot_changes": _with("bronze_claims", "silver_claims") + """
, c AS (SELECT claim_id, claim_id % 211 AS part FROM bronze_claims)
SELECT 'new' AS change, count(DISTINCT claim_id) AS claims FROM c WHERE part = 1
UNION ALL SELECT 'changed', count(DISTINCT claim_id) FROM c WHERE part IN (2, 3)
UNION ALL SELECT 'gone', count(DISTINCT claim_id) FROM c WHERE part = 5
UNION ALL SELECT 'cleaned', count(*) FROM silver_claims WHERE claim_id % 211 IN (1, 2, 3)""",
})
