"""Bronze-shaped views over the TPC-H-like test tables.

The reference lands six insurance tables; the test data is a TPC-H-like
star schema. These views reshape the given tables into the bronze schemas
row by row (narrow projections only: no shuffle except the two small
dimension joins for customers and agents), so every query's work grows with
the given data. The raw values are deliberately dirty (padding, mixed case,
punctuation, hyphens and apostrophes, out-of-range values, null keys, zero
amounts) so the cleaning rules have work to do. All values are derived from
given columns and key arithmetic.

Two views split ``lineitem`` between them: returned lines are claims, all
others are payments. Together they read every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.sources import schemas

AS_OF = "2024-01-01T00:00:00+00:00"

N_AGENTS = 97


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region. The planner broadcasts it if its files' bytes allow; adaptive execution splits
    the 25-key join's hot partitions otherwise."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")


def _stamp(as_of: str) -> str:
    return "'" + as_of.replace("'", "''") + "' AS fetched_at"


# Each proxy is one projection written as SQL expressions (one plan call per
# column instead of one per sub-expression).

def policies(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS policy_id",
        "concat(' pol-', CAST(o_orderkey AS STRING), ' ') AS policy_number",
        "CASE WHEN pmod(o_orderkey, 89) <> 0 THEN o_custkey END AS customer_id",
        f"CASE WHEN pmod(o_orderkey, 83) <> 0 THEN pmod(o_orderkey, {N_AGENTS}) END AS agent_id",
        "concat(lower(o_orderpriority), '\\t') AS policy_type",
        "concat(' ', o_orderstatus, ' ') AS coverage_type",
        "CASE WHEN pmod(o_orderkey, 13) = 0 THEN o_totalprice + 0.004D ELSE o_totalprice END AS premium",
        "CASE WHEN pmod(o_orderkey, 50) = 0 THEN 0.0D ELSE o_totalprice * 10.0D END AS coverage_amount",
        "100 * (1 + pmod(o_orderkey, 6)) AS deductible",
        "o_orderdate AS start_date",
        "o_orderdate + INTERVAL 365 DAYS AS end_date",
        "o_orderstatus AS status",
        _stamp(as_of),
    )
    return _conform(df, schemas.POLICIES)


def claims(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Returned lines (the other lines are payments)."""
    df = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr(
        "l_orderkey * 8 + l_linenumber AS claim_id",
        "CASE WHEN pmod(l_orderkey * 8 + l_linenumber, 101) <> 0 THEN l_orderkey END AS policy_id",
        "concat('clm-', CAST(l_orderkey * 8 + l_linenumber AS STRING)) AS claim_number",
        "concat(' ', lower(l_linestatus), CASE WHEN pmod(l_linenumber, 3) = 0 THEN '-line '"
        " WHEN pmod(l_linenumber, 3) = 1 THEN \"'line \" ELSE ' line ' END, CAST(l_linenumber AS STRING)) AS claim_type",
        "l_shipdate AS incident_date",
        "l_shipdate + INTERVAL 3 DAYS AS reported_date",
        "CASE WHEN l_discount = 0 THEN 0.0D ELSE l_extendedprice END AS claimed_amount",
        "CASE WHEN l_linestatus = 'O' THEN CAST(NULL AS DOUBLE) WHEN pmod(l_partkey, 5) = 0 THEN 0.0D"
        " ELSE l_extendedprice * 0.75D END AS approved_amount",
        "concat(l_linestatus, CAST(pmod(l_partkey, 5) AS STRING)) AS status",
        "concat('line ', CAST(l_linenumber AS STRING), ' of order ', CAST(l_orderkey AS STRING)) AS description",
        _stamp(as_of),
    )
    return _conform(df, schemas.CLAIMS)


def payments(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Lines not returned (returned ones are claims)."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag != 'R'")
    # Exact net price in decimal, plus 3 thousandths so that cleaning's
    # round(2) has work to do but can never meet a tie.
    df = li.selectExpr(
        "l_orderkey * 8 + l_linenumber AS payment_id",
        "CASE WHEN pmod(l_orderkey * 8 + l_linenumber, 103) <> 0 THEN l_orderkey END AS policy_id",
        "concat(' pay-', CAST(l_orderkey * 8 + l_linenumber AS STRING)) AS payment_number",
        "l_shipdate AS payment_date",
        "CASE WHEN pmod(l_partkey, 97) = 0 THEN 0.0D ELSE"
        " CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)"
        " + CAST(0.003 AS DECIMAL(4,3)) AS DOUBLE) END AS amount",
        "concat('way-', lower(l_linestatus), CAST(pmod(l_suppkey, 4) AS STRING), ' ') AS payment_method",
        "CASE WHEN l_returnflag = 'A' AND pmod(l_orderkey, 23) = 0 THEN 'completed'"
        " WHEN l_returnflag = 'A' THEN 'Completed'"
        " ELSE concat('Step ', CAST(pmod(l_linenumber, 3) AS STRING)) END AS status",
        "concat('txn-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id",
        "concat(' ref', CAST(l_partkey AS STRING)) AS reference_number",
        _stamp(as_of),
    )
    return _conform(df, schemas.PAYMENTS)


def customers(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    geo = _geo(spark, sf_dir)
    df = c.join(geo, c.c_nationkey == geo.n_nationkey, "left").selectExpr(
        "c_custkey AS customer_id",
        "concat('  ', lower(c_name)) AS first_name",
        "concat(lower(n_name), '\\t') AS last_name",
        "date_add(DATE'1950-01-01', CAST(pmod(c_custkey * 37, 18000) AS INT)) AS date_of_birth",
        "CASE WHEN pmod(c_custkey, 17) = 0 THEN concat('customer', CAST(c_custkey AS STRING), '.example.com')"
        " WHEN pmod(c_custkey, 19) = 0 THEN CAST(NULL AS STRING)"
        " ELSE concat(' Customer', CAST(c_custkey AS STRING), '@Example.COM ') END AS email",
        "concat('+1 (555) ', lpad(CAST(pmod(c_custkey, 10000) AS STRING), 4, '0')) AS phone",
        "concat(CAST(c_custkey AS STRING), ' Main St') AS address",
        "lower(n_name) AS city",
        "concat(' ', lower(substring(r_name, 1, 2))) AS state",
        "concat(' ', lpad(CAST(pmod(c_custkey, 100000) AS STRING), 5, '0'), ' ') AS zip_code",
        "concat(lower(c_mktsegment), CASE WHEN pmod(c_custkey, 3) = 0 THEN '-hand ' WHEN pmod(c_custkey, 3) = 1"
        " THEN \" o'hara\" ELSE ' ' END) AS occupation",
        "30000.0D + c_acctbal * 10.0D AS annual_income",
        "280 + pmod(c_custkey * 7, 600) AS credit_score",
        "TIMESTAMP_NTZ'2019-01-01 00:00:00' + make_dt_interval(CAST(pmod(c_custkey, 1800) AS INT)) AS join_date",
        _stamp(as_of),
    )
    return _conform(df, schemas.CUSTOMERS)


def agents(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    geo = _geo(spark, sf_dir)
    df = s.join(geo, s.s_nationkey == geo.n_nationkey, "left").selectExpr(
        "CASE WHEN pmod(s_suppkey, 31) <> 0 THEN s_suppkey END AS agent_id",
        "lower(s_name) AS first_name",
        "concat(' ', lower(n_name)) AS last_name",
        "concat(' Agent', CAST(s_suppkey AS STRING), '@Agency.Example ') AS email",
        "concat('(555) 01-', CAST(s_suppkey AS STRING)) AS phone",
        "lower(r_name) AS region",
        "concat(lower(r_name), '-', CAST(pmod(s_suppkey, 5) AS STRING)) AS specialty",
        "concat('lic-', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS license_number",
        "CASE WHEN pmod(s_suppkey, 29) = 0 THEN CAST(NULL AS DOUBLE)"
        " ELSE CAST(5 + pmod(s_suppkey, 11) AS DOUBLE) / 100.0D END AS commission_rate",
        "TIMESTAMP_NTZ'2010-01-01 00:00:00' + make_dt_interval(CAST(pmod(s_suppkey, 3000) AS INT)) AS hire_date",
        "concat('Grade ', CAST(pmod(s_suppkey, 3) AS STRING)) AS status",
        _stamp(as_of),
    )
    return _conform(df, schemas.AGENTS)


def vehicles(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    df = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS vehicle_id",
        "p_partkey AS policy_id",
        "substring(md5(CAST(p_partkey AS STRING)), 1, 17) AS vin",
        "lower(p_brand) AS make",
        "concat(p_name, ' ') AS model",
        "1980 + p_size AS year",
        "lower(p_type) AS vehicle_type",
        "split_part(p_name, ' ', 1) AS color",
        "p_size * 3000 AS mileage",
        "concat(lower(p_type), '-', CAST(pmod(p_partkey, 4) AS STRING)) AS engine_type",
        "concat(' ', lower(substring(p_type, 1, 2))) AS registration_state",
        "date_add(DATE'2025-01-01', p_size) AS registration_expiry",
        _stamp(as_of),
    )
    return _conform(df, schemas.VEHICLES)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documented 'api users' feed: user_id, email, created_at (yyyy-MM-dd text)."""
    c = customers(spark, sf_dir)
    return c.select(
        F.col("customer_id").alias("user_id"),
        F.col("email"),
        F.date_format("join_date", "yyyy-MM-dd").alias("created_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documented validation example input: everything arrives as text."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CAST(o_totalprice AS STRING) AS amount",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS date",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream with some unknown users."""
    return table(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.pmod("user_id", F.lit(53)) != 0, F.col("user_id")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documented raw event feed: timestamp as text, optional e-mail."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    return e.select(
        uid.alias("user_id"),
        F.col("event_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(F.pmod(uid, F.lit(11)) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("User"), uid.cast("string"), F.lit("@Mail.Example"))).alias("email"),
    )


BUILDERS = {
    "customers": customers,
    "policies": policies,
    "claims": claims,
    "vehicles": vehicles,
    "agents": agents,
    "payments": payments,
}
