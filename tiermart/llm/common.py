"""Helpers shared by the corpus operators: tables, Arrow stages, materialisation."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows per Arrow batch handed to Python: whole texts are long, so batches stay small.
ARROW_ROWS = 1000

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder under the one that ``spark.checkpoint.dir`` names, which all executors share.

    Only where the setting is absent on a local master (tests) is a folder chosen here.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc.getCheckpointDir():
        root = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="corpus-ckpt-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    Cuts the lineage, so a lost executor never re-runs what came before.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with one dict of columns per batch; columns follow ``schema``.

    ``rows`` gets a batch and returns {column: list | array} of equal lengths.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    target = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            out = rows(batch)
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) and v.type == f.type else pa.array(v, type=f.type)
                 for f, v in ((f, out[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(stage, target)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, null as None."""
    return column.cast(pa.binary()).to_pylist()


def strings(column: pa.Array) -> list[str | None]:
    """The values of a string column. Spark strings may hold invalid UTF-8: such bytes are read as U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in utf8(column)]


def hash_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, those of least key hash: a counted share first, then exactly so many."""
    n = df.count()
    h = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit("sample"))
    if n > rows:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int(min(1.0, 1.2 * rows / n) * (1 << 40)))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), *[F.col(f"`{k}`") for k in keys]).limit(rows)


def strict_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in that order: extra or clashing columns of the input go no further."""
    return df.select(*[F.col(f"`{n}`") for n in names])
