"""Named queries over the test tables: one per operator / composite job.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the given tables (through the bronze proxies), so its work grows with
them. Stamps use the fixed ``AS_OF`` so results are reproducible.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.functions.numeric import mean_half_up, pct_special, special, sum_money, total_or_nan
from tiermart.operators import frames
from tiermart.operators.joins import suffix_join
from tiermart.operators.quality import profile
from tiermart.plans import gold, silver
from tiermart.sources import proxies
from tiermart.sources.proxies import AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.clean(name, proxies.BUILDERS[name](spark, sf_dir, AS_OF), AS_OF)


def _clean(name: str) -> Query:
    return lambda spark, sf_dir: silver_table(spark, sf_dir, name)


def silver_customer_policies(spark, sf_dir, sort=True):
    return silver.customer_policies(silver_table(spark, sf_dir, "customers"),
                                    silver_table(spark, sf_dir, "policies"), AS_OF, sort=sort)


def silver_policy_claims(spark, sf_dir, sort=True):
    return silver.policy_claims(silver_table(spark, sf_dir, "policies"),
                                silver_table(spark, sf_dir, "claims"), AS_OF, sort=sort)


def gold_claims_summary(spark, sf_dir):
    return gold.claims_summary(silver_table(spark, sf_dir, "claims"), AS_OF)


def gold_premium_revenue(spark, sf_dir):
    return gold.premium_revenue(silver_table(spark, sf_dir, "policies"),
                                silver_table(spark, sf_dir, "payments"), AS_OF)


def gold_agent_performance(spark, sf_dir):
    return gold.agent_performance(silver_table(spark, sf_dir, "agents"), silver_table(spark, sf_dir, "policies"),
                                  silver_table(spark, sf_dir, "claims"), AS_OF)


def gold_customer_risk(spark, sf_dir):
    """G4 in one plan from the cleaned tables (no fan-out table)."""
    return gold.customer_risk_from_clean(silver_table(spark, sf_dir, "customers"),
                                         silver_table(spark, sf_dir, "policies"),
                                         silver_table(spark, sf_dir, "claims"), AS_OF)


def gold_customer_risk_layered(spark, sf_dir):
    """G4 from the two silver join tables, as the layered run reads them."""
    return gold.customer_risk(silver_customer_policies(spark, sf_dir, sort=False),
                              silver_policy_claims(spark, sf_dir, sort=False), AS_OF)


def daily_metrics(spark, sf_dir):
    return gold.daily_metrics(proxies.events(spark, sf_dir))


def clean_users(spark, sf_dir):
    return silver.clean_users(proxies.users(spark, sf_dir))


def monthly_signups(spark, sf_dir):
    return gold.monthly_signups(clean_users(spark, sf_dir))


def validated_events(spark, sf_dir):
    return silver.validated_events(proxies.raw_events(spark, sf_dir))


def validated_orders(spark, sf_dir):
    """P5 + X8: text orders -> required columns, typed amount, parsed date, amount > 0."""
    return silver.validated_orders(proxies.raw_orders(spark, sf_dir))


def daily_amount(spark, sf_dir):
    """A1/A4: total validated order amount per day."""
    return gold.daily_totals(validated_orders(spark, sf_dir))


def profile_output(spark, sf_dir):
    """V2: column profile of the cleaned claims (one pass over the data)."""
    return profile(silver_table(spark, sf_dir, "claims"))


def join_suffix(spark, sf_dir):
    """Orders joined to customers with a colliding column renamed."""
    orders = proxies.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    cust = proxies.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("status"), "c_name")
    return suffix_join(orders, cust, "custkey", "left")


def fill_numeric(spark, sf_dir):
    """Agents LEFT per-agent policy counts, numeric nulls -> 0."""
    agents = silver_table(spark, sf_dir, "agents").select("agent_id", "first_name", "commission_rate")
    counts = silver_table(spark, sf_dir, "policies").groupBy("agent_id").agg(F.count(F.lit(1)).alias("policies"))
    return frames.fill_numeric(agents.join(counts, "agent_id", "left"))


def sum_empty_group(spark, sf_dir):
    """Per policy, claimed total over its claims; 0 when it has none."""
    pc = silver_policy_claims(spark, sf_dir, sort=False)
    return pc.groupBy("policy_id").agg(total_or_nan("claimed_amount").alias("total_claimed"),
                                       F.count("claim_id").alias("claims"))


def sum_nan_group(spark, sf_dir):
    """A4/A5: totals and means per status where some amounts are NaN; such a group is NaN, others are exact."""
    bronze = proxies.claims(spark, sf_dir)
    broken = F.when(F.pmod("claim_id", F.lit(1009)) == 0, F.lit(float("nan"))).otherwise(F.col("claimed_amount"))
    day = F.to_date("incident_date").alias("day")
    return bronze.select(day, broken.alias("amount")).groupBy("day").agg(
        total_or_nan("amount").alias("total"), mean_half_up("amount", 2).alias("mean"))


def sum_nonfinite_group(spark, sf_dir):
    """A4/A5: totals, means and ratios per day where some amounts are infinite, one way or both, or NaN: as IEEE sums
    and divides them; days without such a value are exact."""
    bronze = proxies.claims(spark, sf_dir)
    odd = F.pmod("claim_id", F.lit(1999))
    amount = (F.when(odd < 3, F.lit(float("inf"))).when(odd < 6, F.lit(float("-inf"))).when(odd == 6, F.lit(float("nan")))
              .otherwise(F.col("claimed_amount")))
    approved = F.when(odd.isin(1, 7), F.lit(float("inf"))).otherwise(F.col("approved_amount"))
    sums = bronze.select(F.to_date("incident_date").alias("day"), amount.alias("amount"), approved.alias("approved")).groupBy("day").agg(
        total_or_nan("amount").alias("total"), mean_half_up("amount", 2).alias("mean"),
        special("amount").alias("bits"), F.round(sum_money("amount"), 2).alias("exact"),
        special("approved").alias("approved_bits"), F.round(sum_money("approved"), 2).alias("approved_exact"))
    return sums.select("day", "total", "mean", pct_special("approved_bits", "approved_exact", "bits", "exact").alias("approved_pct"))


def zero_ratio(spark, sf_dir):
    """X11 with zero guard: per agent, claim rate where 0/0 is NaN."""
    return gold_agent_performance(spark, sf_dir).select("agent_id", "total_policies", "claim_rate_pct")


def sort_desc_nulls_first(spark, sf_dir):
    """O2: bronze claims by approved amount, descending, nulls first."""
    return frames.sort_desc(
        proxies.claims(spark, sf_dir).select("claim_id", "approved_amount"), "approved_amount", then=("claim_id",))


def distinct_rows(spark, sf_dir):
    """Whole-row de-duplication (day, user, event type)."""
    e = proxies.table(spark, sf_dir, "events")
    return frames.distinct_rows(e.select(F.to_date("ts").alias("day"), "user_id", "event_type"))


def drop_nulls_subset(spark, sf_dir):
    """drop users without an e-mail."""
    return frames.drop_nulls(proxies.users(spark, sf_dir), ["email"])


QUERIES: dict[str, Query] = {
    "clean_customers": _clean("customers"),
    "clean_policies": _clean("policies"),
    "clean_claims": _clean("claims"),
    "clean_vehicles": _clean("vehicles"),
    "clean_agents": _clean("agents"),
    "clean_payments": _clean("payments"),
    "silver_customer_policies": silver_customer_policies,
    "silver_policy_claims": silver_policy_claims,
    "gold_claims_summary": gold_claims_summary,
    "gold_premium_revenue": gold_premium_revenue,
    "gold_agent_performance": gold_agent_performance,
    "gold_customer_risk": gold_customer_risk,
    "gold_customer_risk_layered": gold_customer_risk_layered,
    "daily_metrics": daily_metrics,
    "clean_users": clean_users,
    "monthly_signups": monthly_signups,
    "validated_events": validated_events,
    "validated_orders": validated_orders,
    "daily_amount": daily_amount,
    "profile_output": profile_output,
    "join_suffix": join_suffix,
    "fill_numeric": fill_numeric,
    "sum_empty_group": sum_empty_group,
    "sum_nan_group": sum_nan_group,
    "sum_nonfinite_group": sum_nonfinite_group,
    "zero_ratio": zero_ratio,
    "sort_desc_nulls_first": sort_desc_nulls_first,
    "distinct_rows": distinct_rows,
    "drop_nulls_subset": drop_nulls_subset,
}


# ---------------------------------------------------------------- storage, sources, streaming, run
# These queries write to the cluster's shared folder (``spark.checkpoint.dir``)
# and read their result back from the written files.

def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    from tiermart.session import shared_dir

    return shared_dir(spark, f"{name}/{uuid.uuid4().hex}")


def read_latest_snapshot(spark, sf_dir):
    """Two committed batches and a newer uncommitted one; the newest committed wins, and a
    re-run of it that is empty, as one that fails, leaves it as it is."""
    from tiermart.sources import lake

    table = f"{_scratch(spark, 'snapshots')}/silver/clean_claims"
    bronze = proxies.claims(spark, sf_dir, AS_OF)
    lake.write_batch(silver.clean("claims", bronze, "2023-12-31T00:00:00+00:00"), table, "20231231T000000Z")
    good = silver.clean("claims", bronze, AS_OF)
    lake.write_batch(good, table, "20240101T000000Z")
    # A newer batch whose write never committed (no log entry): must stay invisible.
    silver.clean("claims", bronze, "2024-01-02T00:00:00+00:00").write.parquet(f"{table}/batch=20240102T000000Z/data-0")
    for rerun in (good.where("claim_id < 0"), good.withColumn("claim_number", F.expr("CAST(claim_number AS INT)"))):
        try:
            lake.write_batch(rerun, table, "20240101T000000Z")
        except Exception:
            continue  # empty, and a value that does not cast
        raise AssertionError("a re-run that must fail was committed")
    return lake.read_latest(spark, table)


def sample_copy(spark, sf_dir):
    """Sample side-copy of a committed batch; its size and how many of its rows the batch has.

    The sample (its size is a setting) is what is sent to the batch's rows, and nulls match.
    """
    from tiermart.sources import lake

    table = f"{_scratch(spark, 'samples')}/silver/clean_payments"
    path = lake.write_batch(silver_table(spark, sf_dir, "payments"), table, "20240101T000000Z")
    lake.write_sample(spark, path, 50)
    sample = lake.read_latest(spark, lake.sample_table_dir(table))
    full = lake.read_attempt(spark, path)
    same = [full[c].eqNullSafe(sample[c]) for c in sample.columns]
    found = full.join(F.broadcast(sample), same, "left_semi").distinct()
    return sample.select(F.lit(1).alias("s"), F.lit(0).alias("f")).union(found.select(F.lit(0), F.lit(1))).agg(
        F.sum("s").alias("sample_rows"), F.sum("f").alias("subset_rows"))


def fallback_write(spark, sf_dir):
    """Primary store unreachable -> write and read through the fallback root."""
    from tiermart.sources import lake

    root = _scratch(spark, "fallback")
    config = lake.LakeConfig(root="unreachable://primary/lake", fallback_root=root, fallback_on_error=True,
                             sample_enabled=False)
    lake.save(silver_table(spark, sf_dir, "payments"), config, "silver", "clean_payments", "20240101T000000Z")
    return lake.load(spark, config, "silver", "clean_payments")


def _land(spark, sf_dir, table: str, fmt: str):
    """A bronze table landed as files with the columns in another order and one more, then ingested from them.

    The added text holds commas, doubled quotes and (in CSV) a line break.
    """
    from tiermart.sources import readers

    path = f"{_scratch(spark, 'landing')}/{table}_{fmt}"
    df = proxies.BUILDERS[table](spark, sf_dir, AS_OF).drop("fetched_at")
    note = F.concat(F.lit('say "hi", '), F.col(df.columns[0]).cast("string"), F.lit("\nnext" if fmt == "csv" else ""))
    landed = df.select(note.alias("note"), *reversed(df.columns))
    if fmt == "csv":
        readers.write_csv(landed, path)
    else:
        getattr(landed.write, fmt)(path)
    return readers.ingest(readers.landed(spark, table, path, fmt, multi_line=fmt == "csv"), table, AS_OF)


def ingest_csv(spark, sf_dir):
    """S14 + S10: claims landed as CSV."""
    return _land(spark, sf_dir, "claims", "csv")


def ingest_customers(spark, sf_dir):
    """S8 from JSON lines."""
    return _land(spark, sf_dir, "customers", "json")


def ingest_policies(spark, sf_dir):
    """S9 from Parquet."""
    return _land(spark, sf_dir, "policies", "parquet")


def ingest_vehicles(spark, sf_dir):
    """S11 from CSV."""
    return _land(spark, sf_dir, "vehicles", "csv")


def ingest_agents(spark, sf_dir):
    """S12 from JSON lines."""
    return _land(spark, sf_dir, "agents", "json")


def ingest_payments(spark, sf_dir):
    """S13 from Parquet."""
    return _land(spark, sf_dir, "payments", "parquet")


def ingest_mixed_files(spark, sf_dir):
    """Policies landed as files that do not agree on their columns, in each format: a third as declared, a
    third in another order and without the deductible, a third with a note. All columns of all files are read; a
    landing of which one part has no premium is refused."""
    from tiermart.sources import readers

    df = proxies.policies(spark, sf_dir, AS_OF).drop("fetched_at")
    third = F.pmod("policy_id", F.lit(3))
    note = F.concat(F.lit('see "'), F.col("policy_number"), F.lit('", page 1'))
    parts = []
    for fmt in ("csv", "json", "parquet"):
        root = f"{_scratch(spark, 'landing')}/policies_{fmt}"

        def land(rows, name):
            writer = rows.write.mode("append")
            if fmt == "csv":
                writer.options(**readers.CSV_OPTIONS).option("header", True).csv(f"{root}/{name}")
            else:
                getattr(writer, fmt)(f"{root}/{name}")

        land(df.where(third == 0), "good")
        land(df.where(third == 1).select(*reversed(df.columns)).drop("deductible"), "good")
        land(df.where(third == 2).select(note.alias("note"), *df.columns), "good")
        parts.append(readers.ingest(readers.landed(spark, "policies", f"{root}/good", fmt), "policies", AS_OF)
                     .select(F.lit(fmt).alias("format"), "note", *df.columns, "fetched_at"))
        land(df.where(third == 0), "bad")
        land(df.where(third == 1).drop("premium"), "bad")
        try:
            readers.landed(spark, "policies", f"{root}/bad", fmt)
        except ValueError as refused:
            if "['premium'] in " not in str(refused):
                raise
        else:
            raise AssertionError(f"a {fmt} file without a required column was read")
    return parts[0].union(parts[1]).union(parts[2])


def ingest_json_sparse(spark, sf_dir):
    """Claims as records that leave nulls out; no record has an approved amount or a description, some have an
    undeclared object. Declared columns are there as typed nulls, so cleaning takes the batch."""
    from tiermart.sources import readers

    path = f"{_scratch(spark, 'landing')}/claims_sparse"
    claims = proxies.claims(spark, sf_dir, AS_OF).drop("fetched_at", "description")
    audit = F.when(F.pmod("claim_id", F.lit(7)) == 0, F.struct(F.col("claim_number").alias("by"), F.struct(
        F.col("claim_id").alias("nr")).alias("entry")))
    claims.withColumn("approved_amount", F.lit(None).cast("double")).withColumn("audit", audit).write.json(path)
    landed = readers.ingest(readers.flatten(readers.landed(spark, "claims", path, "json"), "_"), "claims", AS_OF)
    return silver.clean("claims", landed, AS_OF)


def ingest_json_flat(spark, sf_dir):
    """Nested JSON records (as an API would return them) flattened to parent.child columns."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    from tiermart.sources import readers

    path = f"{_scratch(spark, 'landing')}/customers_json"
    c = proxies.customers(spark, sf_dir, AS_OF)
    c.select(
        "customer_id",
        F.struct(F.col("first_name").alias("first"), F.col("last_name").alias("last")).alias("name"),
        F.struct(F.col("email"), F.col("phone"),
                 F.struct(F.col("city"), F.col("state"), F.col("zip_code").alias("zip")).alias("address"))
        .alias("contact"),
        "annual_income",
    ).write.json(path)
    schema = StructType([
        StructField("customer_id", LongType()),
        StructField("name", StructType([StructField("first", StringType()), StructField("last", StringType())])),
        StructField("contact", StructType([
            StructField("email", StringType()), StructField("phone", StringType()),
            StructField("address", StructType([StructField("city", StringType()), StructField("state", StringType()),
                                               StructField("zip", StringType())]))])),
        StructField("annual_income", DoubleType()),
    ])
    return readers.flatten(readers.read_json(spark, path, schema))


def incremental_clean(spark, sf_dir):
    """Bronze claims land in two batches; two availableNow runs clean each batch once."""
    from tiermart.sources import lake
    from tiermart.streaming.incremental import clean_new_batches

    root = _scratch(spark, "incremental")
    bronze_dir, silver_dir = f"{root}/bronze/claims", f"{root}/silver/clean_claims"
    checkpoint = f"{root}/_checkpoints/clean_claims"
    claims = proxies.claims(spark, sf_dir, AS_OF)
    early = F.year("incident_date") <= 1996
    lake.write_batch(claims.where(early), bronze_dir, "20240101T000000Z")
    clean_new_batches(spark, "claims", bronze_dir, silver_dir, checkpoint, AS_OF)
    lake.write_batch(claims.where(~early | F.col("incident_date").isNull()), bronze_dir, "20240102T000000Z")
    clean_new_batches(spark, "claims", bronze_dir, silver_dir, checkpoint, AS_OF)
    return lake.read_all(spark, silver_dir).drop("batch")


def _run_layers(mart: str) -> Query:
    def query(spark, sf_dir):
        from tiermart.plans.pipeline import run_layers
        from tiermart.sources import lake

        config = lake.LakeConfig(root=_scratch(spark, "run"), sample_enabled=True)
        sources = {t: build(spark, sf_dir, AS_OF) for t, build in proxies.BUILDERS.items()}
        run_layers(spark, config, sources, as_of=AS_OF, stamp="20240101T000000Z")
        return lake.load(spark, config, "gold", mart)
    query.__doc__ = f"G8: the whole bronze -> silver -> gold run into the lake; the {mart} mart read back."
    return query


def _run_clean(table: str) -> Query:
    def query(spark, sf_dir):
        from tiermart.plans.pipeline import clean_table, run_bronze
        from tiermart.sources import lake

        config = lake.LakeConfig(root=_scratch(spark, "run"), sample_enabled=False)
        run_bronze({table: proxies.BUILDERS[table](spark, sf_dir, AS_OF)}, config, AS_OF, "20240101T000000Z")
        clean_table(spark, config, table, AS_OF, "20240101T000000Z")
        return lake.load(spark, config, "silver", f"clean_{table}")
    query.__doc__ = f"G8: {table} landed as a bronze batch, cleaned into a silver batch, read back."
    return query


def validate_steps(spark, sf_dir):
    """V1, V4: what the bronze run recorded of each table (rows, columns), and that an empty input, and one
    without a required column, is refused."""
    from tiermart.operators.quality import validate
    from tiermart.plans.pipeline import run_bronze
    from tiermart.sources import lake, readers

    def refused(step) -> bool:
        try:
            step()
        except ValueError:
            return True
        return False

    config = lake.LakeConfig(root=_scratch(spark, "validate"), sample_enabled=False)
    sources = {t: build(spark, sf_dir, AS_OF) for t, build in proxies.BUILDERS.items()}
    paths = run_bronze(sources, config, AS_OF, "20240101T000000Z")
    rows = []
    for t, path in sorted(paths.items()):
        meta = lake.batch_metadata(spark, path)
        empty = lake.write_batch(sources[t].limit(0), f"{config.root}/empty/{t}", allow_empty=True)
        required = silver.SPECS[t].required
        rows.append((t, meta["row_count"], meta["column_count"],
                     refused(lambda: lake.read_input(spark, empty)),
                     refused(lambda: validate(sources[t].limit(0), check_empty=True)),
                     refused(lambda: readers.ingest(sources[t].drop(required[-1]), t, AS_OF))))
    return spark.createDataFrame(rows, "table string, row_count long, column_count int, empty_batch_refused boolean, "
                                       "empty_frame_refused boolean, missing_column_refused boolean")


def incremental_propagate(spark, sf_dir):
    """R1 end to end: bronze lands and the stream cleans it, but the first propagation fails half way; then a
    batch lands of which cleaning leaves nothing. The next run records that batch as rejected and makes
    good what was missed. Customer risk read back."""
    from tiermart.plans import pipeline
    from tiermart.sources import lake
    from tiermart.streaming.incremental import clean_new_batches, propagate

    config = lake.LakeConfig(root=_scratch(spark, "propagate"), sample_enabled=False)
    sources = {t: build(spark, sf_dir, AS_OF) for t, build in proxies.BUILDERS.items()}
    pipeline.run_bronze(sources, config, AS_OF, "20240101T000000Z")
    for t in pipeline.TABLES:  # a run that ends after cleaning: nothing new is left in the stream
        clean_new_batches(spark, t, lake.table_path(config.root, "bronze", t),
                          lake.table_path(config.root, "silver", f"clean_{t}"),
                          f"{config.root}/_checkpoints/clean_{t}", AS_OF)
    lake.save(sources["claims"].withColumn("claimed_amount", F.lit(0.0)), config, "bronze", "claims", "20240102T000000Z")
    done = propagate(spark, config, AS_OF, stamp="20240102T000001Z")
    if list(done["rejected"]) != ["claims"] or done["cleaned"]:
        raise AssertionError(f"unexpected propagation: {done}")
    return lake.load(spark, config, "gold", "customer_risk")


def propagate_partial(spark, sf_dir):
    """Customers land that match no policy, so one join is empty and the mart on it is blocked; the three marts
    that do not read it are made. A second run finds nothing to do; when good customers land, a third makes
    the rest. Per run and step: how it ended, and the rows of its table."""
    from tiermart.plans import pipeline
    from tiermart.sources import lake
    from tiermart.streaming.incremental import propagate

    config = lake.LakeConfig(root=_scratch(spark, "partial"), sample_enabled=False)
    sources = {t: build(spark, sf_dir, AS_OF) for t, build in proxies.BUILDERS.items()}
    strangers = sources["customers"].withColumn("customer_id", -1 - F.col("customer_id"))
    pipeline.run_bronze({**sources, "customers": strangers}, config, AS_OF, "20240101T000000Z")
    rows = []
    for run in (1, 2, 3):
        if run == 3:
            lake.save(sources["customers"], config, "bronze", "customers", "20240102T000000Z")
        done = propagate(spark, config, AS_OF, f"2024010{run}T000001Z")
        for step in (*pipeline.JOINS, *pipeline.MARTS):
            broken = done.get("not_made", {}).get(step.name)
            status = broken["status"] if broken else "made" if step.name in done.get(step.layer, {}) else "current"
            path = lake.latest(spark, lake.table_path(config.root, step.layer, step.name))
            rows.append((run, step.name, status, lake.batch_metadata(spark, path)["row_count"] if path else 0))
    return spark.createDataFrame(rows, "run int, step string, status string, table_rows long")


def stored_statistics(spark, sf_dir):
    """V2, V4: profile of a stored batch with least and greatest values, from what rode on its write; no pass over it."""
    from tiermart.operators.quality import stored_profile
    from tiermart.sources import lake

    path = lake.write_batch(silver_table(spark, sf_dir, "claims"), f"{_scratch(spark, 'stats')}/silver/clean_claims")
    return stored_profile(spark, lake.batch_metadata(spark, path))


def sorted_output_check(spark, sf_dir):
    """O1: the joined silver tables as written: rows out of order inside a file, files whose keys overlap the next
    one's, rows."""
    from tiermart.operators.frames import order_faults
    from tiermart.sources import lake

    root, parts = _scratch(spark, "sorted"), []
    for name, build, keys in (("customer_policies", silver_customer_policies, ["customer_id", "start_date", "policy_id"]),
                              ("policy_claims", silver_policy_claims, ["policy_id", "incident_date", "claim_id"])):
        path = lake.write_batch(build(spark, sf_dir), f"{root}/silver/{name}")
        parts.append(order_faults(lake.read_attempt(spark, path), keys).select(F.lit(name).alias("table_name"), "*"))
    return parts[0].union(parts[1])


def _earlier_claims(claims):
    """An earlier snapshot of the claims: some not there yet, some with other amounts or states, some gone since."""
    at = F.pmod("claim_id", F.lit(211))
    gone = claims.where(at == 5).withColumn("claim_id", -F.col("claim_id"))
    return claims.where(at != 1).withColumns({
        "claimed_amount": F.when(at == 2, F.col("claimed_amount") + 10).otherwise(F.col("claimed_amount")),
        "status": F.when(at == 3, F.lit("Open")).otherwise(F.col("status")),
        "fetched_at": F.lit("2023-12-31T00:00:00+00:00")}).unionByName(gone)


def _refreshed(spark, sf_dir):
    """Cleaned tables and both marts of the earlier snapshot, written; then what the next one changes."""
    from tiermart.sources import lake
    from tiermart.streaming import changes

    root = _scratch(spark, "changes")

    def stored(df, name, day):
        return lake.read_attempt(spark, lake.write_batch(df, f"{root}/{name}", f"2024010{day}T000000Z"))
    bronze = {t: proxies.BUILDERS[t](spark, sf_dir, AS_OF) for t in ("customers", "policies", "claims")}
    before = stored(_earlier_claims(bronze["claims"]), "bronze/claims", 1)
    after = stored(bronze["claims"], "bronze/claims", 2)
    old = {t: stored(silver.clean(t, before if t == "claims" else b, AS_OF), f"silver/clean_{t}", 1) for t, b in bronze.items()}
    found = stored(changes.changed_keys(before, after, ["claim_id"]), "changes/claims", 2)
    claims, cleaned = changes.refresh_clean("claims", old["claims"], after, found, ["claim_id"], AS_OF)
    new = old | {"claims": stored(claims, "silver/clean_claims", 2)}
    return changes, stored, old, new, found, cleaned


def incremental_changed_groups(spark, sf_dir):
    """Claims summary after a second snapshot, from the first one's mart and the changed claims alone."""
    changes, stored, old, new, found, _ = _refreshed(spark, sf_dir)
    mart = stored(gold.claims_summary(old["claims"], AS_OF), "gold/claims_summary", 1)
    return changes.refresh_claims_summary(mart, old["claims"], new["claims"], found, AS_OF)[0]


def incremental_changed_customers(spark, sf_dir):
    """Customer risk after a second snapshot of the claims; customers whose claims changed are rebuilt."""
    changes, stored, old, new, found, _ = _refreshed(spark, sf_dir)
    mart = stored(gold.customer_risk_from_clean(old["customers"], old["policies"], old["claims"], AS_OF), "gold/customer_risk", 1)
    none = {"customers": "customer_id", "policies": "policy_id"}
    by_table = {t: found.select(F.lit(0).cast("long").alias(k), "change").limit(0) for t, k in none.items()} | {"claims": found}
    return changes.refresh_customer_risk(mart, old, new, by_table, AS_OF)[0]


def snapshot_changes(spark, sf_dir):
    """How many claims are new, changed and gone between two snapshots, and how many rows were cleaned for it."""
    _, _, _, _, found, cleaned = _refreshed(spark, sf_dir)
    return found.groupBy("change").agg(F.count(F.lit(1)).alias("claims")).union(
        cleaned.agg(F.lit("cleaned").alias("change"), F.count(F.lit(1)).alias("claims")))


QUERIES.update({
    "incremental_changed_groups": incremental_changed_groups,
    "incremental_changed_customers": incremental_changed_customers,
    "snapshot_changes": snapshot_changes,
    "propagate_partial": propagate_partial,
    "sorted_output_check": sorted_output_check,
    "stored_statistics": stored_statistics,
    "incremental_propagate": incremental_propagate,
    "read_latest_snapshot": read_latest_snapshot,
    "sample_copy": sample_copy,
    "fallback_write": fallback_write,
    "ingest_csv": ingest_csv,
    "ingest_customers": ingest_customers,
    "ingest_policies": ingest_policies,
    "ingest_vehicles": ingest_vehicles,
    "ingest_agents": ingest_agents,
    "ingest_payments": ingest_payments,
    "ingest_json_flat": ingest_json_flat,
    "ingest_json_sparse": ingest_json_sparse,
    "ingest_mixed_files": ingest_mixed_files,
    "incremental_clean": incremental_clean,
    "validate_steps": validate_steps,
    **{f"run_layers_{m}": _run_layers(m) for m in ("claims_summary", "premium_revenue", "agent_performance",
                                                   "customer_risk")},
    **{f"run_layers_clean_{t}": _run_clean(t) for t in proxies.BUILDERS},
})
