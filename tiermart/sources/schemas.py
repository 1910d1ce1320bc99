"""Declared schemas of the six raw (bronze) tables.

Reads never infer: landed files are read with these schemas so that a type
drift upstream fails loudly instead of silently changing results.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, L, D, DT, TS = StringType(), LongType(), DoubleType(), DateType(), TimestampNTZType()

CUSTOMERS = _schema(
    ("customer_id", L), ("first_name", S), ("last_name", S), ("date_of_birth", DT), ("email", S),
    ("phone", S), ("address", S), ("city", S), ("state", S), ("zip_code", S), ("occupation", S),
    ("annual_income", D), ("credit_score", L), ("join_date", TS), ("fetched_at", S),
)

POLICIES = _schema(
    ("policy_id", L), ("policy_number", S), ("customer_id", L), ("agent_id", L), ("policy_type", S),
    ("coverage_type", S), ("premium", D), ("coverage_amount", D), ("deductible", L),
    ("start_date", TS), ("end_date", TS), ("status", S), ("fetched_at", S),
)

CLAIMS = _schema(
    ("claim_id", L), ("policy_id", L), ("claim_number", S), ("claim_type", S), ("incident_date", TS),
    ("reported_date", TS), ("claimed_amount", D), ("approved_amount", D), ("status", S),
    ("description", S), ("fetched_at", S),
)

VEHICLES = _schema(
    ("vehicle_id", L), ("policy_id", L), ("vin", S), ("make", S), ("model", S), ("year", L),
    ("vehicle_type", S), ("color", S), ("mileage", L), ("engine_type", S), ("registration_state", S),
    ("registration_expiry", DT), ("fetched_at", S),
)

AGENTS = _schema(
    ("agent_id", L), ("first_name", S), ("last_name", S), ("email", S), ("phone", S), ("region", S),
    ("specialty", S), ("license_number", S), ("commission_rate", D), ("hire_date", TS), ("status", S),
    ("fetched_at", S),
)

PAYMENTS = _schema(
    ("payment_id", L), ("policy_id", L), ("payment_number", S), ("payment_date", TS), ("amount", D),
    ("payment_method", S), ("status", S), ("transaction_id", S), ("reference_number", S), ("fetched_at", S),
)

BRONZE = {
    "customers": CUSTOMERS,
    "policies": POLICIES,
    "claims": CLAIMS,
    "vehicles": VEHICLES,
    "agents": AGENTS,
    "payments": PAYMENTS,
}
