"""New bronze batch -> cleaned silver batch -> joins and marts, losing nothing.

``clean_new_batches`` is a file stream over a bronze table's *commit log*
with ``availableNow``: each run takes up the commits since the checkpoint and
stops. It lists that one folder and no data. Data without a commit is never seen, whenever its files appeared. For
each commit the *whole* bronze batch is read and ``clean(bronze batch)``
is written as a new attempt at the silver batch of the same stamp, so a replay
after a crash is idempotent and "latest silver" is ``clean(latest bronze)``.

A batch that cannot be cleaned (nothing is left of it, a column is missing, a
value does not cast) is recorded as rejected, with the reason, and the stream
goes on; storage failures end the run and are replayed by the next one.

``propagate`` then decides from stored state which joins and marts are out of
date: every batch's log entry names the attempts that it was made from. They are made by their dependencies
(``tiermart.plans.pipeline``): one that cannot be made blocks those that read it and no other, and a run that
failed half way is made good by the next, whatever the stream has left to do.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tiermart.plans import pipeline, silver
from tiermart.plans.pipeline import content_fault
from tiermart.sources import lake
from tiermart.sources.lake import LakeConfig


def clean_new_batches(spark: SparkSession, table: str, bronze_dir: str, silver_dir: str, checkpoint: str,
                      as_of: str) -> list[str]:
    """Clean every bronze batch committed since the last run; returns the stamps written."""
    written: list[str] = []

    def process(micro: DataFrame, epoch_id: int) -> None:
        # One row for each new commit. Of several commits of a batch in one go the last one counts.
        commits = sorted(json.loads(r[0])["file_path"] for r in micro.select("value").collect())
        for path in {lake.stamp_of(p): p for p in commits}.values():
            stamp = lake.stamp_of(path)
            try:
                lake.write_batch(silver.clean(table, lake.read_attempt(spark, path), as_of), silver_dir, stamp,
                                 inputs={table: path})
            except Exception as exc:
                if not content_fault(exc):
                    raise
                lake.reject_batch(spark, silver_dir, stamp, f"{type(exc).__name__}: {exc}"[:2000], {table: path})
            else:
                written.append(stamp)

    query = (
        spark.readStream.schema("value string").option("wholetext", True)
        .option("pathGlobFilter", f"*.{lake.COMMIT}.json").text(lake.log_dir(bronze_dir))
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return written


def propagate(spark: SparkSession, config: LakeConfig, as_of: str, stamp: str | None = None) -> dict:
    """Eager propagation: new bronze batches -> cleaned silver -> joined silver -> gold.

    Returns the stamps cleaned, the batches rejected, the joins and marts rebuilt
    (only those whose inputs have moved on), and those ``not_made`` with status and reason: rejected because the data
    does not allow it, or blocked by another one. Keys are left out where there is nothing. Storage failures
    are raised when everything else is done.
    """
    result: dict = {"cleaned": {}}
    rejected = {}
    tables = {t: (lake.table_path(config.root, "bronze", t), lake.table_path(config.root, "silver", f"clean_{t}"))
              for t in pipeline.TABLES}
    tables = {t: dirs for t, dirs in tables.items() if lake.latest(spark, dirs[0]) is not None}

    def stream(t: str) -> list[str]:
        return clean_new_batches(spark, t, *tables[t], f"{config.root.rstrip('/')}/_checkpoints/clean_{t}", as_of)

    with ThreadPoolExecutor(max_workers=pipeline.AT_ONCE) as pool:  # one stream a table, side by side
        streams = {t: pool.submit(stream, t) for t in tables}
    errors = [s.exception() for s in streams.values() if s.exception()]
    for t, (_, silver_dir) in tables.items():
        if not streams[t].exception() and (written := streams[t].result()):
            result["cleaned"][t] = written
        if bad := lake.rejected_batches(spark, silver_dir):
            rejected[t] = {s: r["reason"] for s, r in bad.items()}
    if rejected:
        result["rejected"] = rejected
    stamp = stamp or lake.new_stamp()
    steps = (*pipeline.JOINS, *pipeline.MARTS)
    outcomes = pipeline.run_steps(spark, config, steps, as_of, stamp, False)
    for layer in ("silver", "gold"):
        made = {s.name: outcomes[s.name].path for s in steps if s.layer == layer and outcomes[s.name].status == pipeline.MADE}
        if made:
            result[layer] = made
    not_made = {n: {"status": o.status, "reason": o.reason} for n, o in outcomes.items() if o.status in pipeline.BROKEN}
    if not_made:
        result["not_made"] = not_made
    if errors:
        raise errors[0]
    if any(o.status == pipeline.FAILED for o in outcomes.values()):
        raise pipeline.IncompleteRun(outcomes)
    return result
