"""Silver layer: six cleaned tables, two joined tables, two documented feeds.

All functions are lazy ``DataFrame -> DataFrame``; ``as_of`` is the stamp
written into ``transformed_at`` (a parameter, so results are reproducible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.operators.clean import DIGITS, LOWER, STRIP, TITLE, UPPER, Cast, CleanSpec, apply_spec
from tiermart.operators.frames import distinct_rows, drop_nulls, stamp, to_datetime
from tiermart.operators.joins import left_join_skew_safe, suffix_join
from tiermart.operators.quality import validate

DOUBLE, INT, DATE, DATETIME = "double", "int", "date", "timestamp_ntz"

# A totally ordered join output needs a shuffle for the sort anyway. With a
# sort-merge join the sort's range sampling reads the join's materialized
# shuffle output; after a broadcast join it would recompute scans and
# cleaning. Both sides grow with the data, so a broadcast is not wanted at
# scale either.
SORTED_JOIN = "shuffle_merge"

# Fixed values in the six specs below: required columns, column types and bounds of the tables' contract.
CUSTOMERS = CleanSpec(
    name="customers",
    required=("customer_id", "first_name", "last_name", "email", "join_date"),
    strings={"first_name": TITLE, "last_name": TITLE, "email": LOWER, "phone": DIGITS, "city": TITLE,
             "state": UPPER, "zip_code": STRIP, "occupation": TITLE},
    cast_groups=({"date_of_birth": Cast(DATE), "join_date": Cast(DATETIME)},
                 {"annual_income": Cast(DOUBLE), "credit_score": Cast(INT)}),
    filters=(lambda: F.col("email").contains("@"),
             lambda: F.col("credit_score") >= 300,
             lambda: F.col("credit_score") <= 850),
)

POLICIES = CleanSpec(
    name="policies",
    required=("policy_id", "customer_id", "policy_type", "premium", "status"),
    strings={"policy_number": UPPER, "policy_type": TITLE, "coverage_type": STRIP},
    cast_groups=({"premium": Cast(DOUBLE, 2), "coverage_amount": Cast(DOUBLE), "deductible": Cast(INT),
                  "start_date": Cast(DATETIME), "end_date": Cast(DATETIME)},),
    filters=(lambda: F.col("premium") > 0,
             lambda: F.col("coverage_amount") > 0,
             lambda: F.col("customer_id").isNotNull(),
             lambda: F.col("agent_id").isNotNull()),
)

CLAIMS = CleanSpec(
    name="claims",
    required=("claim_id", "policy_id", "claim_type", "claimed_amount", "status"),
    strings={"claim_number": UPPER, "claim_type": TITLE},
    cast_groups=({"claimed_amount": Cast(DOUBLE, 2), "approved_amount": Cast(DOUBLE),
                  "incident_date": Cast(DATETIME), "reported_date": Cast(DATETIME)},),
    filters=(lambda: F.col("claimed_amount") > 0,
             lambda: F.col("policy_id").isNotNull()),
    # Claims not yet decided count as 0 approved.
    post=({"approved_amount": lambda: F.coalesce(F.col("approved_amount"), F.lit(0.0))},),
)

VEHICLES = CleanSpec(
    name="vehicles",
    required=("vehicle_id", "policy_id", "vin", "make", "model", "year"),
    strings={"vin": UPPER, "make": TITLE, "model": TITLE, "color": TITLE, "vehicle_type": TITLE,
             "engine_type": TITLE, "registration_state": UPPER},
    cast_groups=({"year": Cast(INT), "mileage": Cast(INT), "registration_expiry": Cast(DATE)},),
    filters=(lambda: F.col("year") >= 1990,
             lambda: F.col("year") <= 2025),
)

AGENTS = CleanSpec(
    name="agents",
    required=("agent_id", "first_name", "last_name", "email", "region"),
    strings={"first_name": TITLE, "last_name": TITLE, "email": LOWER, "phone": DIGITS, "region": TITLE,
             "specialty": TITLE, "license_number": UPPER},
    cast_groups=({"commission_rate": Cast(DOUBLE), "hire_date": Cast(DATE)},),
    filters=(lambda: F.col("agent_id").isNotNull(),),
)

PAYMENTS = CleanSpec(
    name="payments",
    required=("payment_id", "policy_id", "amount", "payment_date", "status"),
    strings={"payment_number": UPPER, "payment_method": TITLE, "transaction_id": UPPER,
             "reference_number": UPPER},
    cast_groups=({"amount": Cast(DOUBLE, 2), "payment_date": Cast(DATETIME)},),
    filters=(lambda: F.col("policy_id").isNotNull(),
             lambda: F.col("amount") != 0),
)

SPECS = {s.name: s for s in (CUSTOMERS, POLICIES, CLAIMS, VEHICLES, AGENTS, PAYMENTS)}


def clean(name: str, bronze: DataFrame, as_of: str) -> DataFrame:
    """Apply the table's rules, then stamp ``transformed_at``."""
    return stamp(apply_spec(bronze, SPECS[name]), "transformed_at", as_of)


def customer_policies(customers: DataFrame, policies: DataFrame, as_of: str, sort: bool = True) -> DataFrame:
    """Customers INNER policies on customer_id, restamped.

    Inner join: adaptive execution splits a hot customer on either side.
    """
    validate(customers, ["customer_id", "first_name", "last_name"])
    validate(policies, ["policy_id", "customer_id", "policy_type", "premium"])
    joined = suffix_join(customers, policies, "customer_id", "inner", strategy=SORTED_JOIN if sort else None)
    if sort:
        # policy_id breaks ties so one customer's rows can span range partitions.
        joined = joined.orderBy(F.col("customer_id").asc_nulls_first(), F.col("start_date").asc_nulls_first(),
                                F.col("policy_id").asc_nulls_first())
    return stamp(joined, "transformed_at", as_of)


def policy_claims(policies: DataFrame, claims: DataFrame, as_of: str, sort: bool = True) -> DataFrame:
    """Policies LEFT claims on policy_id, ``has_claim``, restamped.

    Claims are the many side; one policy may own a large share of them, so
    the skew-tolerant left join is used.
    """
    validate(policies, ["policy_id", "customer_id", "policy_type"])
    validate(claims, ["claim_id", "policy_id", "claimed_amount"])
    joined = left_join_skew_safe(policies, claims, "policy_id", strategy=SORTED_JOIN if sort else None)
    if sort:
        # claim_id breaks ties so one policy's claims can span range partitions.
        joined = joined.orderBy(F.col("policy_id").asc_nulls_first(), F.col("incident_date").asc_nulls_first(),
                                F.col("claim_id").asc_nulls_first())
    joined = joined.withColumn("has_claim", F.col("claim_id").isNotNull())
    return stamp(joined, "transformed_at", as_of)


def clean_users(raw_users: DataFrame) -> DataFrame:
    """G7b (documented): drop rows without e-mail, lower-case it, parse the
    day into a datetime (midnight)."""
    validate(raw_users, ["user_id", "email", "created_at"])
    return drop_nulls(raw_users, ["email"]).withColumns({
        "email": F.lower("email"),
        "created_at": to_datetime("created_at", "%Y-%m-%d"),
    })


# P5 (documented recipe): required columns -> typed casts -> business rule.
VALIDATED_ORDERS = CleanSpec(
    name="orders",
    required=("order_id", "amount", "date"),
    cast_groups=({"amount": Cast(DOUBLE), "date": Cast(DATE, fmt="%Y-%m-%d")},),
    filters=(lambda: F.col("amount") > 0,),
)


def validated_orders(raw: DataFrame) -> DataFrame:
    return apply_spec(raw, VALIDATED_ORDERS)


def validated_events(raw_events: DataFrame) -> DataFrame:
    """G7a (documented): drop rows with any null, de-duplicate, parse, lower-case."""
    validate(raw_events, ["timestamp", "email"])
    return distinct_rows(drop_nulls(raw_events)).withColumns({
        "timestamp": to_datetime("timestamp", "%Y-%m-%d %H:%M:%S"),
        "email": F.lower("email"),
    })
