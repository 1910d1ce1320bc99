"""Snapshots (S1-S7), landed sources (S14, S15, S17), incremental clean (R1), run."""

import pytest
from pyspark.sql import functions as F

from tiermart.sources import lake, readers
from tiermart.sources.lake import LakeConfig


def test_latest_committed_wins(spark, scratch):
    t = f"{scratch}/silver/t"
    df = spark.range(10)
    lake.write_batch(df, t, "20240101T000000Z")
    lake.write_batch(df.where("id < 3"), t, "20240102T000000Z")
    df.write.parquet(f"{t}/batch=20240103T000000Z/data-1")  # never committed
    with pytest.raises(ValueError, match="empty"):
        lake.write_batch(df.where("id < 0"), t, "20240104T000000Z")
    assert lake.committed_batches(spark, t) == ["20240101T000000Z", "20240102T000000Z"]
    assert lake.read_latest(spark, t).count() == 3
    assert "batch" in lake.read_latest(spark, t, with_batch=True).columns


def test_same_stamp_rerun_overwrites(spark, scratch):
    t = f"{scratch}/silver/t"
    lake.write_batch(spark.range(10), t, "20240101T000000Z")
    lake.write_batch(spark.range(4), t, "20240101T000000Z")
    assert lake.read_latest(spark, t).count() == 4


def test_missing_table_and_bad_args(spark, scratch):
    with pytest.raises(FileNotFoundError):
        lake.read_latest(spark, f"{scratch}/nothing/here")
    with pytest.raises(ValueError):
        lake.read_latest(spark, " ")
    with pytest.raises(ValueError):
        lake.table_path("/x", "", "t")


def test_sample_never_picked_as_latest(spark, scratch):
    config = LakeConfig(root=scratch, sample_rows=5)
    path = lake.save(spark.range(100), config, "silver", "t", "20240101T000000Z")
    assert lake.load(spark, config, "silver", "t").count() == 100
    assert lake.read_latest(spark, lake.sample_table_dir(lake.table_of(path))).count() == 5
    meta = lake.batch_metadata(spark, path)
    assert (meta["row_count"], meta["column_count"], meta["columns"]) == (100, 1, ["id"])
    assert meta["column_types"] == {"id": "bigint"} and meta["file_path"] == path


def test_fallback(spark, scratch):
    off = LakeConfig(root="unreachable://nowhere/lake", fallback_root=scratch, fallback_on_error=False,
                     sample_enabled=False)
    with pytest.raises(RuntimeError, match="fallback is off"):
        lake.save(spark.range(3), off, "gold", "g")
    on = LakeConfig(root="unreachable://nowhere/lake", fallback_root=scratch, fallback_on_error=True,
                    sample_enabled=False)
    lake.save(spark.range(3), on, "gold", "g", "20240101T000000Z")
    assert lake.load(spark, on, "gold", "g").count() == 3
    mirrored = LakeConfig(root=f"{scratch}/primary", fallback_root=f"{scratch}/mirror", fallback_on_error=True,
                          sample_enabled=False)
    lake.save(spark.range(5), mirrored, "gold", "g", "20240101T000000Z")
    assert lake.read_latest(spark, lake.table_path(f"{scratch}/mirror", "gold", "g")).count() == 5


def test_resolve_path():
    assert lake.resolve_path("bronze", "x.parquet", base="/d") == "/d/bronze/x.parquet"
    uri = lake.resolve_path("gold", "t", backend="adls", base="lake", account="acct", container="c")
    assert uri == "abfss://c@acct.dfs.core.windows.net/lake/gold/t"
    with pytest.raises(ValueError):
        lake.resolve_path("gold", "t", backend="adls")
    with pytest.raises(ValueError):
        lake.resolve_path("gold", "t", backend="ftp")


def test_flatten(spark):
    df = spark.createDataFrame([(1, (2, (3, "x")))], "a long, b struct<c: long, d: struct<e: long, f: string>>")
    flat = readers.flatten(df)
    assert flat.columns == ["a", "b.c", "b.d.e", "b.d.f"]
    assert tuple(flat.first()) == (1, 2, 3, "x")


def test_jdbc_options():
    o = readers.jdbc_options("jdbc:postgresql://h/db", "SELECT * FROM orders WHERE created_at > now() - interval '7 days'")
    assert o["query"].startswith("SELECT") and "partitionColumn" not in o
    p = readers.jdbc_options("jdbc:x", "SELECT 1", partition_column="id", lower_bound=0, upper_bound=100,
                             num_partitions=8)
    assert p["dbtable"].startswith("(SELECT 1)") and p["numPartitions"] == "8" and "query" not in p
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "SELECT 1", partition_column="id")


def test_incremental_processes_each_batch_once(spark, scratch):
    from tiermart.sources import proxies
    from tiermart.streaming.incremental import clean_new_batches

    claims = proxies.claims(spark, "/root/testdata/sf0.001")
    bronze, silver_dir, ckpt = f"{scratch}/bronze/claims", f"{scratch}/silver/claims", f"{scratch}/ckpt"
    lake.write_batch(claims.where(F.year("incident_date") <= 1996), bronze, "20240101T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240101T000000Z"]
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == []  # nothing new
    lake.write_batch(claims.where(F.year("incident_date") > 1996), bronze, "20240102T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240102T000000Z"]
    from tiermart.plans import silver

    expected = silver.clean("claims", claims, "x").count()
    assert lake.read_all(spark, silver_dir).count() == expected
    # latest silver = clean(latest bronze)
    latest_bronze = lake.read_latest(spark, bronze)
    assert lake.read_latest(spark, silver_dir).count() == silver.clean("claims", latest_bronze, "x").count()


def test_run_layers_subset_and_order(spark, scratch):
    from tiermart.plans.pipeline import run_layers
    from tiermart.sources import proxies

    config = LakeConfig(root=scratch, sample_enabled=False)
    sources = {t: b(spark, "/root/testdata/sf0.001") for t, b in proxies.BUILDERS.items()}
    out = run_layers(spark, config, sources, layers=("bronze",), stamp="20240101T000000Z")
    assert set(out) == {"bronze"} and len(out["bronze"]) == 6
    out = run_layers(spark, config, layers=("silver", "gold"), stamp="20240101T000001Z")
    assert set(out["gold"]) == {"claims_summary", "premium_revenue", "agent_performance", "customer_risk"}
    assert lake.load(spark, config, "gold", "customer_risk").count() > 0
    with pytest.raises(ValueError):
        run_layers(spark, config, layers=("platinum",))


def test_config_from_env(monkeypatch):
    monkeypatch.setenv("DUAL_WRITE_SAMPLE_SIZE", "7")
    monkeypatch.setenv("DISABLE_LOCAL_SAMPLE", "true")
    monkeypatch.setenv("ADLS_FALLBACK_TO_LOCAL", "true")
    c = LakeConfig.from_env("/r", "/f")
    assert (c.sample_rows, c.sample_enabled, c.fallback_on_error) == (7, False, True)
    monkeypatch.setenv("DUAL_WRITE_SAMPLE_SIZE", "-3")
    assert LakeConfig.from_env("/r").sample_rows == 50
    monkeypatch.setenv("DUAL_WRITE_SAMPLE_SIZE", "abc")
    assert LakeConfig.from_env("/r").sample_rows == 50


def test_iso_stamp_format():
    import re

    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00", lake.iso_now())
    assert re.fullmatch(r"\d{8}T\d{6}Z", lake.new_stamp())


def test_propagate_rebuilds_downstream_only_when_new(spark, scratch):
    from tiermart.plans.pipeline import run_layers
    from tiermart.sources import proxies
    from tiermart.streaming.incremental import propagate

    config = LakeConfig(root=scratch, sample_enabled=False)
    sources = {t: b(spark, "/root/testdata/sf0.001") for t, b in proxies.BUILDERS.items()}
    run_layers(spark, config, sources, layers=("bronze",), stamp="20240101T000000Z")
    first = propagate(spark, config, "x", stamp="20240101T000001Z")
    assert sorted(first["cleaned"]) == sorted(proxies.BUILDERS) and "gold" in first
    assert propagate(spark, config, "x") == {"cleaned": {}}  # nothing new: nothing written
    assert lake.load(spark, config, "gold", "customer_risk").count() > 0


def test_incremental_survives_a_failed_micro_batch(spark, scratch, monkeypatch):
    from tiermart.plans import silver
    from tiermart.sources import proxies
    from tiermart.streaming import incremental

    claims = proxies.claims(spark, "/root/testdata/sf0.001")
    bronze, silver_dir, ckpt = f"{scratch}/bronze/claims", f"{scratch}/silver/claims", f"{scratch}/ckpt"
    lake.write_batch(claims, bronze, "20240101T000000Z")
    real_write = lake.write_batch

    def crash_after_write(df, path, stamp=None, allow_empty=False):
        real_write(df, path, stamp, allow_empty)  # output written, then the driver "dies"
        raise RuntimeError("simulated failure after the write")

    monkeypatch.setattr(incremental.lake, "write_batch", crash_after_write)
    with pytest.raises(Exception):
        incremental.clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x")
    monkeypatch.setattr(incremental.lake, "write_batch", real_write)
    # the micro-batch was not committed to the checkpoint: it is replayed and overwrites the same batch
    assert incremental.clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240101T000000Z"]
    assert lake.read_all(spark, silver_dir).count() == silver.clean("claims", claims, "x").count()


def test_landed_files_feed_the_bronze_run(spark, scratch):
    from tiermart.plans.pipeline import run_layers
    from tiermart.sources import proxies

    sources = {}
    for fmt, table in [("csv", "claims"), ("json", "agents"), ("parquet", "policies")]:
        path = f"{scratch}/landing/{table}"
        df = proxies.BUILDERS[table](spark, "/root/testdata/sf0.001").drop("fetched_at")
        if fmt == "csv":
            readers.write_csv(df, path)
        else:
            getattr(df.write, fmt)(path)
        sources[table] = readers.landed(spark, table, path, fmt)
        got = sources[table].select(df.columns)
        assert got.exceptAll(df).isEmpty() and df.exceptAll(got).isEmpty()
    out = run_layers(spark, LakeConfig(root=f"{scratch}/lake", sample_enabled=False), sources,
                     layers=("bronze",), stamp="20240101T000000Z")
    assert sorted(out["bronze"]) == ["agents", "claims", "policies"]
    with pytest.raises(ValueError):
        readers.landed(spark, "claims", "/x", "xlsx")


def test_failing_and_empty_reruns_leave_the_old_batch(spark, scratch):
    t, stamp = f"{scratch}/silver/t", "20240101T000000Z"
    first = lake.write_batch(spark.range(10), t, stamp)
    bad = spark.range(10).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    for df in (bad, spark.range(0)):
        with pytest.raises(Exception):
            lake.write_batch(df, t, stamp)
        assert lake.latest(spark, t) == first and lake.read_latest(spark, t).count() == 10
    second = lake.write_batch(spark.range(4), t, stamp)
    assert lake.latest(spark, t) == second and lake.read_attempt(spark, first).count() == 10
    assert lake.prune(spark, t) >= 1 and lake.read_latest(spark, t).count() == 4


def test_latest_lists_only_what_it_must(spark, scratch, monkeypatch):
    t = f"{scratch}/silver/t"
    for day in range(1, 6):
        lake.write_batch(spark.range(day), t, f"2024010{day}T000000Z")
    seen = []
    real = lake._names
    monkeypatch.setattr(lake, "_names", lambda s, p: seen.append(p) or real(s, p))
    assert lake.latest(spark, t).startswith(f"{t}/batch=20240105T000000Z/") and len(seen) == 2


def test_empty_inputs_are_refused_by_their_marker(spark, scratch):
    config = LakeConfig(root=scratch, sample_enabled=False)
    lake.write_batch(spark.range(0), lake.table_path(scratch, "bronze", "claims"), allow_empty=True)
    with pytest.raises(ValueError, match="empty"):
        lake.load(spark, config, "bronze", "claims")
    assert lake.load(spark, config, "bronze", "claims", allow_empty=True).count() == 0


def test_scratch_folder_must_be_named():
    from tiermart.session import shared_dir

    class Unset:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Unset(), "x")


def bronze_setup(spark, scratch):
    from tiermart.sources import proxies

    return (proxies.claims(spark, "/root/testdata/sf0.001"), f"{scratch}/bronze/claims", f"{scratch}/silver/clean_claims",
            f"{scratch}/ckpt")


def test_stream_sees_committed_batches_only(spark, scratch):
    from tiermart.streaming.incremental import clean_new_batches

    claims, bronze, silver_dir, ckpt = bronze_setup(spark, scratch)
    claims.write.parquet(f"{bronze}/batch=20240101T000000Z/data-0")
    lake.write_batch(claims, bronze, "20240102T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240102T000000Z"]
    # its commit comes late: the stream takes it up then
    lake.write_batch(claims, bronze, "20240101T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240101T000000Z"]
    assert lake.committed_batches(spark, silver_dir) == ["20240101T000000Z", "20240102T000000Z"]
    # a re-run of a batch is a commit of its own
    lake.write_batch(claims.limit(50), bronze, "20240102T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240102T000000Z"]
    assert lake.read_latest(spark, silver_dir).count() <= 50


@pytest.mark.parametrize("spoil", [
    lambda df: df.withColumn("claimed_amount", F.lit(0.0)),  # nothing is left
    lambda df: df.withColumn("claimed_amount", F.lit("twelve")),  # does not cast
    lambda df: df.drop("claim_number"),  # a cleaned column is missing
])
def test_bad_batch_is_recorded_and_passed(spark, scratch, spoil):
    from tiermart.streaming.incremental import clean_new_batches

    claims, bronze, silver_dir, ckpt = bronze_setup(spark, scratch)
    lake.write_batch(claims, bronze, "20240101T000000Z")
    lake.write_batch(spoil(claims), bronze, "20240102T000000Z")
    lake.write_batch(claims, bronze, "20240103T000000Z")
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240101T000000Z", "20240103T000000Z"]
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == []
    rejected = lake.rejected_batches(spark, silver_dir)
    assert list(rejected) == ["20240102T000000Z"] and rejected["20240102T000000Z"]["reason"]
    lake.write_batch(claims, bronze, "20240102T000000Z")  # put right
    assert clean_new_batches(spark, "claims", bronze, silver_dir, ckpt, "x") == ["20240102T000000Z"]
    assert not lake.rejected_batches(spark, silver_dir)


def test_propagation_that_failed_is_made_good(spark, scratch, monkeypatch):
    from tiermart.plans import pipeline
    from tiermart.sources import proxies
    from tiermart.streaming.incremental import propagate

    config = LakeConfig(root=scratch, sample_enabled=False)
    sources = {t: b(spark, "/root/testdata/sf0.001") for t, b in proxies.BUILDERS.items()}
    pipeline.run_bronze(sources, config, "x", "20240101T000000Z")
    real = pipeline.run_steps

    def down(*args):
        raise RuntimeError("storage is down")
    monkeypatch.setattr(pipeline, "run_steps", down)
    with pytest.raises(RuntimeError):
        propagate(spark, config, "x", "20240101T000001Z")
    monkeypatch.setattr(pipeline, "run_steps", real)
    again = propagate(spark, config, "x", "20240101T000002Z")
    assert again["cleaned"] == {} and len(again["silver"]) == 2 and len(again["gold"]) == 4
    assert propagate(spark, config, "x") == {"cleaned": {}}
    # new payments touch the one mart that reads them
    lake.save(sources["payments"], config, "bronze", "payments", "20240102T000000Z")
    third = propagate(spark, config, "x", "20240102T000001Z")
    assert list(third["gold"]) == ["premium_revenue"] and "silver" not in third
