"""Runs by dependencies, the commit log, read-time fallback, statistics on the write, proof of order."""

import json
import logging

import pytest
from pyspark.sql import functions as F

from tiermart.operators.frames import order_faults
from tiermart.operators.quality import profile, stored_profile
from tiermart.plans import pipeline
from tiermart.plans.pipeline import BLOCKED, CURRENT, FAILED, MADE, REJECTED, WAITING, IncompleteRun, Outcome, Step, run_dag
from tiermart.sources import lake
from tiermart.sources.lake import LakeConfig
from tiermart.streaming import incremental


# ---------------------------------------------------------------- dependencies
def test_steps_start_when_their_inputs_have_ended():
    order = []

    def task(name, status=MADE):
        return lambda: order.append(name) or Outcome(status, reason="why")
    got = run_dag({"d": {"b", "c"}, "b": {"a"}, "c": {"a"}, "a": set(), "x": set(), "y": {"x"}, "z": {"y"}},
                  {n: task(n, REJECTED if n == "x" else MADE) for n in "dbcaxyz"}, at_once=3)
    assert list(got) == list("dbcaxyz") and order.index("a") < order.index("b") < order.index("d") > order.index("c")
    assert {n: o.status for n, o in got.items()} == {**dict.fromkeys("abcd", MADE), "x": REJECTED, "y": BLOCKED, "z": BLOCKED}
    assert (got["y"].reason, got["z"].reason) == ("x", "y") and "y" not in order
    with pytest.raises(ValueError, match="wait for each other"):
        run_dag({"a": {"b"}, "b": {"a"}}, {"a": task("a"), "b": task("b")})


def steps(spark, calls):
    def double(df, as_of):
        calls.append("double")
        return df.select((F.col("id") * 2).alias("id"))

    def big(df, as_of):
        calls.append("big")
        return df.where("id > 100")
    return [Step("gold", "after_big", ("big",), double), Step("silver", "big", ("base",), big), Step("gold", "other", ("base",), double)]


def test_a_rejected_step_blocks_only_what_reads_it_and_is_not_tried_again_in_vain(spark, scratch):
    config, calls = LakeConfig(root=scratch, sample_enabled=False), []
    names = {s.name: s for s in steps(spark, calls)}

    def run(stamp):
        calls.clear()
        got = pipeline.run_steps(spark, config, names.values(), "x", stamp, again=False)
        return [got[n].status for n in ("big", "after_big", "other")]
    assert run("20240101T000000Z") == [WAITING] * 3
    lake.write_batch(spark.range(10), f"{scratch}/silver/base", "20240101T000000Z")
    assert run("20240101T000001Z") == [REJECTED, BLOCKED, MADE]
    assert "empty" in lake.last_rejection(spark, f"{scratch}/silver/big")["reason"]
    assert run("20240101T000002Z") == [REJECTED, BLOCKED, CURRENT] and calls == []
    lake.write_batch(spark.range(200), f"{scratch}/silver/base", "20240102T000000Z")
    assert run("20240102T000001Z") == [MADE, MADE, MADE]
    assert lake.last_rejection(spark, f"{scratch}/silver/big") is None
    assert run("20240102T000002Z") == [CURRENT] * 3


def test_storage_failures_are_tried_again(spark, scratch, monkeypatch):
    config = LakeConfig(root=scratch, sample_enabled=False)
    lake.write_batch(spark.range(200), f"{scratch}/silver/base", "20240101T000000Z")
    todo = steps(spark, [])
    real = lake.save

    def down(df, config, layer, table, *args, **kw):
        if table == "big":
            raise OSError("disk on fire")
        return real(df, config, layer, table, *args, **kw)
    monkeypatch.setattr(lake, "save", down)
    got = pipeline.run_steps(spark, config, todo, "x", "20240101T000001Z", again=False)
    assert [got[n].status for n in ("big", "after_big", "other")] == [FAILED, BLOCKED, MADE] and "fire" in got["big"].reason
    monkeypatch.setattr(lake, "save", real)
    got = pipeline.run_steps(spark, config, todo, "x", "20240101T000002Z", again=False)
    assert [got[n].status for n in ("big", "after_big", "other")] == [MADE, MADE, CURRENT]


def test_errors_are_told_by_their_kind(spark, scratch):
    def caught(action):
        with pytest.raises(Exception) as info:
            action()
        return info.value
    one = spark.range(1)
    assert pipeline.content_fault(caught(lambda: one.select("nothing").collect()))
    assert pipeline.content_fault(caught(lambda: one.select(F.lit("x").cast("int")).collect()))
    assert pipeline.content_fault(caught(lambda: one.select(F.expr("1 / (id - id)")).collect()))
    assert pipeline.content_fault(ValueError("DataFrame is empty"))
    assert not pipeline.content_fault(caught(lambda: spark.read.parquet(f"{scratch}/nowhere")))
    assert not pipeline.content_fault(OSError("full"))


def test_run_layers_makes_what_it_can_and_then_says_what_it_could_not(spark, scratch):
    from tiermart.sources import proxies

    config = LakeConfig(root=scratch, sample_enabled=False)
    sources = {t: b(spark, "/root/testdata/sf0.001") for t, b in proxies.BUILDERS.items()}
    sources["vehicles"] = sources["vehicles"].drop("vin")  # a leaf: nothing reads it
    sources["payments"] = sources["payments"].withColumn("amount", F.lit(0.0))
    with pytest.raises(IncompleteRun) as raised:
        pipeline.run_layers(spark, config, sources, as_of="x", stamp="20240101T000000Z")
    got = {n: o.status for n, o in raised.value.outcomes.items()}
    broken = {n: s for n, s in got.items() if s != MADE}
    assert broken == {"vehicles": REJECTED, "clean_vehicles": BLOCKED, "clean_payments": REJECTED, "premium_revenue": BLOCKED}
    for mart in ("claims_summary", "agent_performance", "customer_risk"):
        assert lake.load(spark, config, "gold", mart).count() > 0
    assert "vin" in str(raised.value)


# ---------------------------------------------------------------- commit log
def test_questions_about_history_list_one_folder(spark, scratch, monkeypatch):
    t = f"{scratch}/silver/t"
    seen = []
    real = lake._names
    monkeypatch.setattr(lake, "_names", lambda s, p: seen.append(p) or real(s, p))

    def listings(question):
        seen.clear()
        question()
        return len(seen)
    counts = []
    for day in (1, 2, 3):
        for n in range(day * 2):
            lake.write_batch(spark.range(2), t, f"2024010{day}T00000{n}Z")
        lake.reject_batch(spark, t, f"2024020{day}T000000Z", "why", {"a": "b"})
        counts.append([listings(lambda: lake.committed_batches(spark, t)), listings(lambda: lake.rejected_batches(spark, t)),
                       listings(lambda: lake.read_all(spark, t)), listings(lambda: lake.latest(spark, t)),
                       listings(lambda: lake.last_rejection(spark, t))])
    assert counts == [[1, 1, 1, 2, 1]] * 3
    assert len(lake.committed_batches(spark, t)) == 12 and list(lake.rejected_batches(spark, t)) == [
        "20240201T000000Z", "20240202T000000Z", "20240203T000000Z"]
    assert lake.read_all(spark, t).count() == 24


def test_prune_drops_replaced_attempts_and_their_entries(spark, scratch):
    t = f"{scratch}/silver/t"
    for n in (5, 3):
        lake.write_batch(spark.range(n), t, "20240101T000000Z")
    lake.reject_batch(spark, t, "20240102T000000Z", "why", {})
    assert lake.prune(spark, t) == 1 and len(lake._names(spark, lake.log_dir(t))) == 2
    assert lake.read_latest(spark, t).count() == 3 and list(lake.rejected_batches(spark, t)) == ["20240102T000000Z"]


def test_the_stream_reads_the_log_alone(spark, scratch, monkeypatch):
    """Whatever else lies in the table's folder is not looked at, not even listed."""
    from tiermart.sources import proxies

    bronze = f"{scratch}/bronze/claims"
    lake.write_batch(proxies.claims(spark, "/root/testdata/sf0.001"), bronze, "20240101T000000Z")
    lake._write_text(spark, f"{bronze}/batch=20240105T000000Z/20240105T000000Z.1.commit.json", "no log entry")
    got = incremental.clean_new_batches(spark, "claims", bronze, f"{scratch}/silver/clean_claims", f"{scratch}/ckpt", "x")
    assert got == ["20240101T000000Z"]


# ---------------------------------------------------------------- read-time fallback
def break_files(spark, path):
    fs, jpath = lake._fs(spark, path)
    fs.delete(jpath, True)


def test_a_batch_that_cannot_be_opened_is_read_elsewhere(spark, scratch, caplog):
    both = LakeConfig(root=f"{scratch}/a", fallback_root=f"{scratch}/b", fallback_on_error=True, sample_enabled=False)
    alone = LakeConfig(root=f"{scratch}/a", sample_enabled=False)
    lake.save(spark.range(3), both, "gold", "t", "20240101T000000Z")
    newest = lake.save(spark.range(5), both, "gold", "t", "20240102T000000Z")
    break_files(spark, newest)
    with caplog.at_level(logging.WARNING):
        assert lake.load(spark, both, "gold", "t").count() == 5  # the other root has it
        assert lake.load(spark, alone, "gold", "t").count() == 3  # the batch before
    assert newest in caplog.text
    break_files(spark, lake.latest(spark, f"{scratch}/b/gold/t"))
    assert lake.load(spark, both, "gold", "t").count() == 3


def test_a_broken_entry_or_footer_counts_as_unreadable(spark, scratch):
    both = LakeConfig(root=f"{scratch}/a", fallback_root=f"{scratch}/b", fallback_on_error=True, sample_enabled=False)
    path = lake.save(spark.range(4), both, "gold", "t", "20240101T000000Z")
    entry = lake._committed(spark, f"{scratch}/a/gold/t")["20240101T000000Z"].file(f"{scratch}/a/gold/t")
    text = lake._read_text(spark, entry)
    lake._write_text(spark, entry, "{half")
    assert lake.load_path(spark, both, "gold", "t").startswith(f"{scratch}/b/")
    lake._write_text(spark, entry, text)
    assert lake.load_path(spark, both, "gold", "t") == path
    for name in lake._names(spark, path):
        if name.endswith(".parquet"):
            lake._write_text(spark, f"{path}/{name}", "not parquet")
    assert lake.load(spark, both, "gold", "t").count() == 4
    with pytest.raises(Exception):
        lake.load(spark, LakeConfig(root=f"{scratch}/a"), "gold", "t")


# ---------------------------------------------------------------- statistics, order
def test_statistics_of_the_write_equal_a_pass_over_the_batch(spark, scratch):
    df = spark.sql("""select * from values (1L, 1.5D, 'a', date'2024-01-02', true, array(1), timestamp_ntz'2024-01-01 01:02:03', 1.50BD),
                      (null, double('NaN'), null, null, null, null, null, null), (-3L, double('-Infinity'), 'b', date'2020-01-01', false, array(), null, 2.25BD)
                      as t(`a.b`, d, s, day, flag, list, at, money)""")
    path = lake.write_batch(df, f"{scratch}/t")
    meta = lake.batch_metadata(spark, path)
    got = {r["column"]: (r["position"], r["type"], r["rows"], r["nulls"], r["least"], r["most"]) for r in stored_profile(spark, meta).collect()}
    assert {c: v[:4] for c, v in got.items()} == {
        r["column"]: (r["position"], r["type"], r["rows"], r["nulls"]) for r in profile(lake.read_attempt(spark, path)).collect()}
    assert got["a.b"][4:] == ("-3", "1") and got["d"][4:] == ("-Infinity", "NaN") and got["s"][4:] == (None, None)
    assert got["day"][4:] == ("2020-01-01", "2024-01-02") and got["flag"][4:] == ("false", "true") and got["money"][4:] == ("1.50", "2.25")
    assert got["at"][4:] == ("2024-01-01 01:02:03",) * 2 and got["list"][4:] == (None, None)
    empty = lake.batch_metadata(spark, lake.write_batch(df.limit(0), f"{scratch}/e", allow_empty=True))
    assert [r["nulls"] for r in stored_profile(spark, empty).collect()] == [0] * 8 and json.dumps(empty)


def test_order_faults_are_counted(spark, scratch):
    def faults(df, name):
        df.write.parquet(f"{scratch}/{name}")
        return tuple(order_faults(spark.read.parquet(f"{scratch}/{name}"), ["a", "b"]).first())
    rows = [(None, None), (None, 1), (1, None), (1, 2), (1, 2), (2, 0), (3, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert faults(df.coalesce(1), "one") == (0, 0, 7)
    assert faults(df.repartitionByRange(3, "a", "b").sortWithinPartitions("a", "b"), "ranges") == (0, 0, 7)
    assert faults(df.coalesce(1).sortWithinPartitions(F.desc("a"), F.desc("b")), "down") == (5, 0, 7)
    hashed = faults(df.repartition(3, "b").sortWithinPartitions("a", "b"), "hashed")
    assert hashed[0] == 0 and hashed[1] > 0
    assert faults(df.limit(0), "none") == (0, 0, 0)
