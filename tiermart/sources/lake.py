"""Snapshot storage: one directory per table, one sub-directory per batch, one folder per attempt, one flat commit log.

Layout::

    {root}/{layer}/{table}/batch={YYYYMMDDTHHMMSSZ}/data-{attempt}/part-*.parquet
    {root}/{layer}/{table}/commits/{YYYYMMDDTHHMMSSZ}.{attempt}.commit.json
                                  /{YYYYMMDDTHHMMSSZ}.{attempt}.reject.json

* ``write_batch`` writes an attempt into a folder of its own in one Spark job,
  counts its rows and takes its column statistics with an ``Observation`` that rides on that job (no second
  pass), refuses an empty result, and last of all writes the attempt's log entry.
  A re-run of a batch touches nothing that is there: until its entry appears
  (one small file, created whole), readers see the attempt before it, and a
  re-run that fails or is empty leaves that one in place. Attempt names sort by
  time; the newest committed one is the batch.
* The log is one folder whose names say it all: which batches there are, which attempt is a batch's, what was rejected.
  Every question about a table's history is one listing of it, however many batches there are; data folders are
  listed only to be read. Names sort by batch, then by attempt, so "greatest name" equals "newest". The stream
  reads the same folder.
* An entry's content records the output's shape and statistics and the attempts that it was made from
  (``inputs``), so what is out of date can be told from storage alone.
* The sample side-copy is taken from the committed files, not by re-running
  the plan, so it costs a read of the first file(s) only.
* ``prune`` removes attempts that a newer one of the same batch has replaced, with their log entries.
"""

from __future__ import annotations

import json
import logging
import os
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermart.operators.quality import recorded, statistics, validate

log = logging.getLogger(__name__)

# Environment settings a user of the reference already sets
# (sample size, sample switch, fallback switch), read by LakeConfig.from_env.
ENV_SAMPLE_SIZE = "DUAL_WRITE_SAMPLE_SIZE"
ENV_DISABLE_SAMPLE = "DISABLE_LOCAL_SAMPLE"
ENV_FALLBACK = "ADLS_FALLBACK_TO_LOCAL"

LOG, COMMIT, REJECT, DATA = "commits", "commit", "reject", "data-"
BATCH_PREFIX = "batch="
STAMP_FORMAT = "%Y%m%dT%H%M%SZ"
BACKENDS = ("local", "adls")


def new_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(STAMP_FORMAT)


def iso_now() -> str:
    """ISO-8601 UTC stamp with seconds precision (``+00:00`` suffix)."""
    return datetime.now(timezone.utc).replace(microsecond=0).isoformat()


@dataclass(frozen=True)
class LakeConfig:
    """Where tables live and what extra copies a write keeps."""

    root: str
    fallback_root: str | None = None
    fallback_on_error: bool = False
    sample_rows: int = 50
    sample_enabled: bool = True

    @staticmethod
    def from_env(root: str, fallback_root: str | None = None) -> "LakeConfig":
        raw = os.environ.get(ENV_SAMPLE_SIZE, "50")
        try:
            rows = int(raw)
        except ValueError:
            rows = 50
        return LakeConfig(
            root=root,
            fallback_root=fallback_root,
            fallback_on_error=os.environ.get(ENV_FALLBACK, "false").lower() == "true",
            sample_rows=rows if rows >= 0 else 50,
            sample_enabled=os.environ.get(ENV_DISABLE_SAMPLE, "false").lower() != "true",
        )


def _brief(exc: Exception) -> str:
    """First line of an error; Spark's go on with a stack trace."""
    return str(exc).strip().split("\n", 1)[0]


# ---------------------------------------------------------------- paths
def resolve_path(layer: str, name: str, backend: str = "local", base: str = "data",
                 account: str | None = None, container: str | None = None) -> str:
    """Local path or ``abfss://`` URI for a table; Spark's Hadoop connectors do the I/O."""
    for arg, label in ((layer, "layer"), (name, "name")):
        if not isinstance(arg, str) or not arg.strip():
            raise ValueError(f"{label} must be a non-empty string")
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend!r}; expected one of {BACKENDS}")
    if backend == "local":
        return os.path.join(base, layer, name)
    if not account or not container:
        raise ValueError("remote backend needs an account and a container")
    return f"abfss://{container}@{account}.dfs.core.windows.net/{base.strip('/')}/{layer}/{name}"


def table_path(root: str, layer: str, table: str) -> str:
    for arg, label in ((layer, "layer"), (table, "table")):
        if not isinstance(arg, str) or not arg.strip():
            raise ValueError(f"{label} must be a non-empty string")
    return f"{root.rstrip('/')}/{layer}/{table}"


# ---------------------------------------------------------------- Hadoop FS helpers
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _new_attempt() -> str:
    """Names sort by the time an attempt began; the random part tells apart those of one instant."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if it does not exist."""
    fs, jpath = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []


class Entry(NamedTuple):
    """A line of a table's log, as its file's name has it; they sort by batch, then by attempt."""

    stamp: str
    attempt: str
    kind: str

    def file(self, table_dir: str) -> str:
        return f"{log_dir(table_dir)}/{self.stamp}.{self.attempt}.{self.kind}.json"

    def data(self, table_dir: str) -> str:
        return f"{_batch_dir(table_dir, self.stamp)}/{DATA}{self.attempt}"


def log_dir(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/{LOG}"


def _log(spark: SparkSession, table_dir: str) -> list[Entry]:
    """The whole log of a table, oldest batch first: one listing."""
    parts = (n.split(".") for n in _names(spark, log_dir(table_dir)))
    return sorted(Entry(*p[:3]) for p in parts if len(p) == 4 and p[2] in (COMMIT, REJECT))


def _batch_dir(table_dir: str, stamp: str) -> str:
    return f"{table_dir.rstrip('/')}/{BATCH_PREFIX}{stamp}"


def _committed(spark: SparkSession, table_dir: str) -> dict[str, Entry]:
    """Stamp -> newest committed attempt, oldest batch first."""
    return {e.stamp: e for e in _log(spark, table_dir) if e.kind == COMMIT}


def committed_batches(spark: SparkSession, table_dir: str) -> list[str]:
    """Stamps of the committed batches, oldest first."""
    return list(_committed(spark, table_dir))


def latest(spark: SparkSession, table_dir: str) -> str | None:
    """Data folder of the newest committed batch. One whose files are gone is passed over with a warning."""
    for entry in reversed(_committed(spark, table_dir).values()):
        path = entry.data(table_dir)
        if _names(spark, path):
            return path
        log.warning("committed batch without files: %s", path)
    return None


def stamp_of(data_path: str) -> str:
    return data_path.rstrip("/").rsplit("/", 2)[1][len(BATCH_PREFIX):]


def table_of(data_path: str) -> str:
    return data_path.rstrip("/").rsplit("/", 2)[0]


# ---------------------------------------------------------------- write (S3)
def write_batch(df: DataFrame, table_dir: str, stamp: str | None = None, allow_empty: bool = False,
                inputs: dict[str, str] | None = None) -> str:
    """Write ``df`` as an attempt at one batch of ``table_dir`` and commit it; returns the path of its files."""
    if df is None:
        raise ValueError("DataFrame is None")
    validate(df)
    entry = Entry(stamp or new_stamp(), _new_attempt(), COMMIT)
    path = entry.data(table_dir)
    obs = Observation(f"rows_{entry.attempt}")
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *statistics(df)).write.parquet(path)
    seen = obs.get
    rows = int(seen["rows"])
    if rows == 0 and not allow_empty:
        raise ValueError("DataFrame is empty")
    meta = {"row_count": rows, "column_count": len(df.columns), "columns": df.columns,
            "column_types": {f.name: f.dataType.simpleString() for f in df.schema.fields}, "file_path": path,
            "inputs": inputs or {}, "statistics": recorded(df, seen)}
    _write_text(df.sparkSession, entry.file(table_dir), json.dumps(meta))
    log.info("committed %s: %d rows x %d columns", path, rows, len(df.columns))  # V4 shape log, no extra job
    return path


def reject_batch(spark: SparkSession, table_dir: str, stamp: str, reason: str, inputs: dict[str, str]) -> None:
    """Record that a batch could not be made from ``inputs``, and why. It stays without data."""
    _write_text(spark, Entry(stamp, _new_attempt(), REJECT).file(table_dir), json.dumps({"reason": reason, "inputs": inputs}))
    log.warning("rejected %s batch %s: %s", table_dir, stamp, reason)


def _entry_text(spark: SparkSession, table_dir: str, entry: Entry) -> dict:
    return json.loads(_read_text(spark, entry.file(table_dir)))


def rejected_batches(spark: SparkSession, table_dir: str) -> dict[str, dict]:
    """Stamp -> newest rejection (reason, inputs) of the batches that have one and no commit after it."""
    last = {e.stamp: e for e in _log(spark, table_dir)}
    return {s: _entry_text(spark, table_dir, e) for s, e in last.items() if e.kind == REJECT}


def last_rejection(spark: SparkSession, table_dir: str) -> dict | None:
    """The rejection (reason, inputs) that is the last thing that happened to the table, if it is one."""
    entry = max(_log(spark, table_dir), key=lambda e: e.attempt, default=None)
    return _entry_text(spark, table_dir, entry) if entry and entry.kind == REJECT else None


def batch_metadata(spark: SparkSession, data_path: str) -> dict:
    """What the log records of a batch: row_count, column_count, columns, column_types, file_path, inputs, statistics."""
    attempt = data_path.rstrip("/").rsplit("/", 1)[1][len(DATA):]
    table = table_of(data_path)
    return _entry_text(spark, table, Entry(stamp_of(data_path), attempt, COMMIT))


def prune(spark: SparkSession, table_dir: str) -> int:
    """Delete attempts older than their batch's committed one, and their log entries; returns how many data folders went.

    For use when no reader can still be on an older attempt, and the stream has taken up the newer ones.
    """
    kept, gone = _committed(spark, table_dir), 0
    for stamp, entry in kept.items():
        for name in _names(spark, _batch_dir(table_dir, stamp)):
            if name.startswith(DATA) and name[len(DATA):] < entry.attempt:
                fs, jpath = _fs(spark, f"{_batch_dir(table_dir, stamp)}/{name}")
                gone += bool(fs.delete(jpath, True))
    for e in _log(spark, table_dir):
        if e.stamp in kept and e.attempt < kept[e.stamp].attempt:
            fs, jpath = _fs(spark, e.file(table_dir))
            fs.delete(jpath, False)
    return gone


# ---------------------------------------------------------------- read
def read_attempt(spark: SparkSession, data_path: str, schema=None) -> DataFrame:
    """One attempt's files."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(data_path)


def latest_or_raise(spark: SparkSession, table_dir: str) -> str:
    if not isinstance(table_dir, str) or not table_dir.strip():
        raise ValueError("table path must be a non-empty string")
    try:
        path = latest(spark, table_dir)
    except Exception as exc:  # listing failed: storage unreachable
        raise RuntimeError(f"cannot list {table_dir}: {exc}") from exc
    if path is None:
        raise FileNotFoundError(f"no committed batch under {table_dir}")
    return path


def read_latest(spark: SparkSession, table_dir: str, schema=None, with_batch: bool = False,
                allow_empty: bool = True) -> DataFrame:
    """The newest committed batch of a table (optionally with its ``batch`` column).

    With ``allow_empty=False`` a batch without rows raises; the count is the log's, no job runs.
    """
    path = latest_or_raise(spark, table_dir)
    if not allow_empty and batch_metadata(spark, path)["row_count"] == 0:
        raise ValueError("DataFrame is empty")
    df = read_attempt(spark, path, schema)
    return df.withColumn("batch", F.lit(stamp_of(path))) if with_batch else df


def read_all(spark: SparkSession, table_dir: str) -> DataFrame:
    """Every committed batch of a table, with its ``batch`` column."""
    paths = [e.data(table_dir) for e in _committed(spark, table_dir).values()]
    if not paths:
        raise FileNotFoundError(f"no committed batch under {table_dir}")
    return spark.read.option("basePath", table_dir).option("mergeSchema", True).parquet(*paths)


# ---------------------------------------------------------------- sample copy
def sample_table_dir(table_dir: str) -> str:
    head, tail = table_dir.rstrip("/").rsplit("/", 1)
    return f"{head}/sample_{tail}"


def write_sample(spark: SparkSession, data_path: str, rows: int = 50) -> str | None:
    """First ``rows`` rows of a committed batch, as one small file; failures only warn.

    A limit reads partitions in turn until it has enough, so a sample of a huge
    batch starts few tasks.
    """
    target = sample_table_dir(table_of(data_path))
    try:
        sample = spark.createDataFrame(read_attempt(spark, data_path).limit(max(rows, 0)).toArrow()).coalesce(1)
        return write_batch(sample, target, stamp_of(data_path), allow_empty=True)
    except Exception as exc:  # a sample is a convenience copy, never fatal
        log.warning("sample copy to %s failed: %s", target, _brief(exc))
        return None


# ---------------------------------------------------------------- write/read with fallback
def save(df: DataFrame, config: LakeConfig, layer: str, table: str, stamp: str | None = None,
         inputs: dict[str, str] | None = None) -> str:
    """Write a batch to the primary root; optionally fall back, mirror and sample.

    * primary write fails: with ``fallback_on_error`` write to the fallback
      root instead, otherwise raise RuntimeError;
    * primary write succeeds and a fallback root is set with
      ``fallback_on_error``: copy the committed batch there too (read back
      from the files: the plan is not recomputed; a failed copy only warns);
    * unless disabled, keep a small sample copy next to the table.
    """
    stamp = stamp or new_stamp()
    spark = df.sparkSession
    primary = table_path(config.root, layer, table)
    fallback = table_path(config.fallback_root, layer, table) if config.fallback_root else None
    try:
        path = write_batch(df, primary, stamp, inputs=inputs)
    except ValueError:
        raise  # empty output or bad arguments: not a storage failure
    except Exception as exc:
        if not (config.fallback_on_error and fallback):
            raise RuntimeError(f"write to {primary} failed and fallback is off: {exc}") from exc
        log.warning("write to %s failed, writing to %s: %s", primary, fallback, _brief(exc))
        try:
            path = write_batch(df, fallback, stamp, inputs=inputs)
        except ValueError:
            raise
        except Exception as exc2:
            raise RuntimeError(f"storage write failed for {layer}/{table}: {exc2}") from exc2
    else:
        if config.fallback_on_error and fallback:
            try:  # the mirror copy is a convenience: its failure is not fatal
                write_batch(read_attempt(spark, path), fallback, stamp, inputs=inputs)
            except Exception as exc:
                log.warning("mirror copy to %s failed: %s", fallback, _brief(exc))
    if config.sample_enabled:
        write_sample(spark, path, config.sample_rows)
    return path


def load(spark: SparkSession, config: LakeConfig, layer: str, table: str, schema=None,
         allow_empty: bool = False) -> DataFrame:
    """Latest batch from the primary root; if that cannot be read, from the fallback root.

    An empty batch raises ValueError (its log entry tells), unless it is allowed.
    """
    return read_input(spark, load_path(spark, config, layer, table), schema, allow_empty)


def load_path(spark: SparkSession, config: LakeConfig, layer: str, table: str) -> str:
    """Data folder of the batch that ``load`` reads: the first that can be opened.

    In turn: the primary root's newest batch, the fallback root's newest, then the older ones of both. Opened means that
    its log entry was read and a footer of its files, so a batch that is listed but cannot be read is noticed here.
    Whatever keeps one from being opened is logged; if none can be, the first such error is raised.
    """
    errors: list[Exception] = []

    def listed(root: str) -> list[str]:
        where = table_path(root, layer, table)
        try:
            return [e.data(where) for e in reversed(_committed(spark, where).values())]
        except Exception as exc:  # storage unreachable
            errors.append(RuntimeError(f"cannot list {where}: {exc}"))
            return []

    def opened(paths: list[str]) -> str | None:
        for path in paths:
            try:
                batch_metadata(spark, path)
                read_attempt(spark, path)  # reads a footer for the schema
                return path
            except Exception as exc:
                errors.append(exc)
                log.warning("%s cannot be read: %s", path, _brief(exc))
        return None

    own = listed(config.root)
    found = opened(own[:1])
    if found is None:
        other = listed(config.fallback_root) if config.fallback_root else []
        found = opened(other[:1]) or opened(own[1:]) or opened(other[1:])
    if found is None:
        raise errors[0] if errors else FileNotFoundError(f"no committed batch under {table_path(config.root, layer, table)}")
    return found


def read_input(spark: SparkSession, data_path: str, schema=None, allow_empty: bool = False) -> DataFrame:
    if not allow_empty and batch_metadata(spark, data_path)["row_count"] == 0:
        raise ValueError("DataFrame is empty")
    return read_attempt(spark, data_path, schema)
