"""Cleaning rules C1-C6 on hand-written edge rows (FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tiermart.plans import silver
from tiermart.sources import schemas

AS_OF = "2024-01-01T00:00:00+00:00"


def frame(spark, table, rows):
    schema = schemas.BRONZE[table]
    names = [f.name for f in schema.fields]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, schema)


def test_customers(spark):
    base = dict(customer_id=1, first_name="\t o'brien ", last_name="SMITH-jones", email=" A@B.COM ",
                phone="+1 (555) １２３ x12", city=" new york", state=" ny ", zip_code=" 01234 ",
                occupation="self-employed", annual_income=1.0, credit_score=300,
                join_date=dt.datetime(2020, 1, 1), date_of_birth=dt.date(1990, 1, 1))
    rows = [base,
            {**base, "customer_id": 2, "email": "no-at-sign"},
            {**base, "customer_id": 3, "email": None},
            {**base, "customer_id": 4, "credit_score": 299},
            {**base, "customer_id": 5, "credit_score": 850},
            {**base, "customer_id": 6, "credit_score": 851},
            {**base, "customer_id": 7, "credit_score": None}]
    out = silver.clean("customers", frame(spark, "customers", rows), AS_OF).orderBy("customer_id").collect()
    assert [r.customer_id for r in out] == [1, 5]
    r = out[0]
    assert (r.first_name, r.last_name, r.email, r.phone) == ("O'Brien", "Smith-Jones", "a@b.com", "1555１２３12")
    assert (r.city, r.state, r.zip_code, r.occupation) == ("New York", "NY", "01234", "Self-Employed")
    assert r.transformed_at == AS_OF and isinstance(r.credit_score, int)


def test_policies_round_before_filter(spark):
    base = dict(policy_id=1, policy_number=" pol-1 ", customer_id=1, agent_id=1, policy_type="multi-line",
                coverage_type=" Full ", premium=10.004, coverage_amount=5.0, deductible=500,
                start_date=dt.datetime(2020, 1, 1), end_date=dt.datetime(2021, 1, 1), status="Active")
    rows = [base,
            {**base, "policy_id": 2, "premium": 0.004},  # rounds to 0.00 -> dropped
            {**base, "policy_id": 3, "coverage_amount": 0.0},
            {**base, "policy_id": 4, "customer_id": None},
            {**base, "policy_id": 5, "agent_id": None}]
    out = silver.clean("policies", frame(spark, "policies", rows), AS_OF).collect()
    assert [r.policy_id for r in out] == [1]
    assert (out[0].premium, out[0].policy_type, out[0].policy_number) == (10.0, "Multi-Line", "POL-1")


def test_claims_pending_counts_zero(spark):
    base = dict(claim_id=1, policy_id=1, claim_number=" c-1", claim_type="water damage", claimed_amount=100.0,
                approved_amount=None, status="Pending")
    rows = [base, {**base, "claim_id": 2, "claimed_amount": 0.0}, {**base, "claim_id": 3, "policy_id": None}]
    out = silver.clean("claims", frame(spark, "claims", rows), AS_OF).collect()
    assert len(out) == 1 and out[0].approved_amount == 0.0 and out[0].claim_type == "Water Damage"


def test_vehicles_year_range_and_strict_cast(spark):
    base = dict(vehicle_id=1, policy_id=1, vin="abc", make="honda", model="cr-v", year=1990, mileage=10)
    rows = [{**base, "vehicle_id": i, "year": y} for i, y in enumerate([1989, 1990, 2025, 2026])]
    out = silver.clean("vehicles", frame(spark, "vehicles", rows), AS_OF).collect()
    assert sorted(r.year for r in out) == [1990, 2025] and out[0].model == "Cr-V"
    too_big = frame(spark, "vehicles", [{**base, "mileage": 2**40}])
    with pytest.raises(Exception):
        silver.clean("vehicles", too_big, AS_OF).collect()


def test_agents_and_payments(spark):
    agents = frame(spark, "agents", [dict(agent_id=None, first_name="x", last_name="y", email="e", region="r"),
                                     dict(agent_id=1, first_name="x", last_name="y", email=" E@X ", region="north east",
                                          specialty="multi-line", license_number="ab-1")])
    out = silver.clean("agents", agents, AS_OF).collect()
    assert len(out) == 1 and (out[0].email, out[0].region, out[0].specialty) == ("e@x", "North East", "Multi-Line")
    base = dict(payment_id=1, policy_id=1, amount=10.0, status="completed", payment_method="credit card",
                payment_date=dt.datetime(2020, 1, 1))
    pays = frame(spark, "payments", [base, {**base, "payment_id": 2, "amount": 0.0},
                                     {**base, "payment_id": 3, "amount": 0.001},
                                     {**base, "payment_id": 4, "amount": -5.0},
                                     {**base, "payment_id": 5, "policy_id": None}])
    out = silver.clean("payments", pays, AS_OF).orderBy("payment_id").collect()
    assert [r.payment_id for r in out] == [1, 4]
    assert out[0].payment_method == "Credit Card" and out[0].status == "completed"  # status untouched


def test_clean_is_idempotent(spark):
    from tiermart.sources import proxies

    once = silver.clean("customers", proxies.customers(spark, "/root/testdata/sf0.001"), AS_OF)
    twice = silver.clean("customers", once.withColumn("join_date", F.col("join_date")), AS_OF)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_missing_required_column(spark):
    df = spark.createDataFrame([(1,)], "claim_id long")
    with pytest.raises(ValueError, match="Missing required columns"):
        silver.clean("claims", df, AS_OF)


def test_validated_orders_recipe(spark):
    raw = spark.createDataFrame([(1, "10.5", "2024-01-31"), (2, "-1", "2024-02-01"), (3, "0", "2024-02-02")],
                                "order_id long, amount string, date string")
    out = silver.validated_orders(raw).collect()
    assert [(r.order_id, r.amount, str(r.date)) for r in out] == [(1, 10.5, "2024-01-31")]
    with pytest.raises(ValueError, match="Missing required columns"):
        silver.validated_orders(raw.drop("date"))
    bad = spark.createDataFrame([(1, "10.5", "31/01/2024")], "order_id long, amount string, date string")
    with pytest.raises(Exception):
        silver.validated_orders(bad).collect()


def test_clean_users_parses_datetime(spark):
    raw = spark.createDataFrame([(1, "A@X.COM", "2024-05-06"), (2, None, "2024-05-07")],
                                "user_id long, email string, created_at string")
    out = silver.clean_users(raw).collect()
    assert len(out) == 1 and out[0].email == "a@x.com"
    assert out[0].created_at == dt.datetime(2024, 5, 6)
