"""Structural checks and output profiles.

``validate`` is a driver-side schema check (no Spark job). Emptiness is
checked where it costs nothing: a step's inputs by the row count in their
log entry, its output through the ``Observation`` that rides on the
write job (both in ``tiermart.sources.lake``). ``check_empty`` is for a
DataFrame that is no stored table; it stops at the first row.

Column statistics (nulls, least and greatest value) ride on the write as well (``statistics``, ``recorded``), so the
profile of a stored batch (``stored_profile``) needs no job over its data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType


def validate(df: DataFrame | None, required: list[str] | tuple[str, ...] | None = None,
             check_empty: bool = False) -> None:
    # The three error texts, which callers of the steps may match.
    if df is None:
        raise ValueError("DataFrame is None")
    if required:
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"Missing required columns: {missing}")
    if check_empty and df.isEmpty():
        raise ValueError("DataFrame is empty")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: (column, type, rows, nulls), from a single pass."""
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(names)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                 F.lit(i).alias("position"), F.col(f"__n{i}").alias("nulls"))
        for i, c in enumerate(names)
    ]
    return (
        counts.select(F.col("__rows").alias("rows"), F.explode(F.array(*entries)).alias("e"))
        .select(F.col("e.position").alias("position"), F.col("e.column").alias("column"),
                F.col("e.type").alias("type"), F.col("rows"), F.col("e.nulls").alias("nulls"))
    )


# Types whose least and greatest value are recorded. Text is left out: values may be long, and personal.
_RANGED = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


def statistics(df: DataFrame) -> list[Column]:
    """Aggregates for an ``Observation``: nulls of every column, least and greatest value of numbers, times and flags."""
    out = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        out.append(F.count_if(c.isNull()).alias(f"nulls{i}"))
        if isinstance(f.dataType, _RANGED):
            out += [F.min(c).cast("string").alias(f"least{i}"), F.max(c).cast("string").alias(f"most{i}")]
    return out


def recorded(df: DataFrame, seen: dict) -> dict[str, dict]:
    """What an ``Observation`` of ``statistics`` saw, by column; values as text. NaN is greater than any number."""
    return {f.name: {"nulls": int(seen[f"nulls{i}"])} | ({"least": seen[f"least{i}"], "most": seen[f"most{i}"]}
                                                         if isinstance(f.dataType, _RANGED) else {})
            for i, f in enumerate(df.schema.fields)}


def stored_profile(spark: SparkSession, meta: dict) -> DataFrame:
    """``profile`` of a stored batch, from what its log entry records: (position, column, type, rows, nulls, least, most)."""
    rows = [(i, c, meta["column_types"][c], meta["row_count"], s["nulls"], s.get("least"), s.get("most"))
            for i, (c, s) in enumerate((c, meta["statistics"][c]) for c in meta["columns"])]
    return spark.createDataFrame(rows, "position int, column string, type string, rows long, nulls long, least string, most string")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)
