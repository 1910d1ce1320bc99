"""Which landed file lacks which column: told apart from columns that are there and null.

Files of one landing need not agree on their columns, so one file's header or footer says nothing of the
others. Each format is asked in its own way, for all files:

* Parquet: the files are read with a schema that gives every asked column an existence default, which Spark fills
  in where a file does not have the column, and only there. Rows that hold the default are asked for; the
  filter is pushed down, and as no value is equal to it, a file that has the columns is done with its
  footer's statistics. Only files that lack one are read, and of these only the asked columns.
* JSON lines: the keys of every record. A file has a column if one of its records has the key, whatever its value.
* CSV: the first record of every file, one small read each; files are grouped by it.

Files without rows say nothing and lose nothing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

NAMED = 20  # files that an error lists
HEADER_BYTES = 1 << 16
AT_ONCE = 16
# Values that no landed column holds, as SQL literals by type; text gets a mark of its own.
_OUTLIERS = {
    ByteType: "-128Y", ShortType: "-32767S", IntegerType: "-2147483647", LongType: "-9223372036854775807L",
    FloatType: "CAST('-3.1234567e38' AS FLOAT)", DoubleType: "CAST('-1.7123456789e308' AS DOUBLE)",
    DateType: "DATE'-4712-01-01'", TimestampType: "TIMESTAMP'-4712-01-01 00:00:01'",
    TimestampNTZType: "TIMESTAMP_NTZ'-4712-01-01 00:00:01'", StringType: "'\\u0001column absent\\u0001'",
}


def outlier(kind: DataType) -> str | None:
    """SQL literal of a value that stands for "the file has no such column"; None for types that have no room for one."""
    if isinstance(kind, DecimalType):
        return f"CAST('-{'9' * (kind.precision - kind.scale)}.{'9' * kind.scale}' AS {kind.simpleString()})"
    return _OUTLIERS.get(type(kind))


def parquet_schema(spark: SparkSession, path: str | list[str]) -> StructType:
    """Columns of all files together, from their footers; two files that disagree on a type end in an error."""
    return spark.read.option("mergeSchema", True).parquet(*([path] if isinstance(path, str) else path)).schema


def parquet_missing(spark: SparkSession, path: str, names: list[str], schema: StructType) -> DataFrame:
    """(file, column) of the asked columns that a Parquet file with rows does not have; ``schema`` is all files' together."""
    kinds = {f.name: f.dataType for f in schema.fields}
    everywhere = [n for n in names if n not in kinds]
    asked = {n: outlier(kinds[n]) for n in names if n in kinds}
    probe = StructType([StructField(n, kinds[n], True, {"EXISTS_DEFAULT": v, "CURRENT_DEFAULT": v})
                        for n, v in asked.items() if v])
    file = F.col("_metadata.file_path").alias("file")
    parts = []
    if probe.fields:
        rows = spark.read.schema(probe).parquet(path)
        absent = {n: rows[n] == F.expr(asked[n]) for n in probe.names}
        lists = F.array(*[F.when(c, F.lit(n)) for n, c in absent.items()])
        parts.append(rows.where(reduce(lambda a, b: a | b, absent.values())).select(file, F.explode(lists).alias("column")).where(
            "column is not null").distinct())
    # Columns that no file has, and types without an outlier: no default to look for.
    for name in everywhere:
        parts.append(spark.read.parquet(path).select(file).distinct().select("file", F.lit(name).alias("column")))
    odd = [n for n, v in asked.items() if v is None]
    if odd:  # one footer after the other
        found = [(f, n) for f in spark.read.parquet(path).inputFiles() for n in odd
                 if n not in spark.read.parquet(plain_path(spark, f)).columns]
        parts.append(spark.createDataFrame(found, "file string, column string"))
    if not parts:
        return spark.createDataFrame([], "file string, column string")
    return reduce(DataFrame.union, parts)


def json_missing(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(file, column) of the asked columns that no record of a file of JSON lines has as a key."""
    keys = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.json_object_keys("value").alias("keys"))
    held = keys.groupBy("file").agg(*[F.max(F.coalesce(F.array_contains("keys", n), F.lit(False))).alias(f"h{i}")
                                      for i, n in enumerate(names)])
    lists = F.array(*[F.when(~F.col(f"h{i}"), F.lit(n)) for i, n in enumerate(names)])
    return held.select("file", F.explode(lists).alias("column")).where("column is not null")


def plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a file's URI stands for (URIs have their special characters encoded)."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def _first_bytes(spark: SparkSession, path: str, size: int) -> bytes:
    """The beginning of a file, unpacked if its name says that it is packed."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    codec = sc._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    raw = at.getFileSystem(conf).open(at)
    stream = codec.createInputStream(raw) if codec is not None else raw
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """First record -> files that begin with it, in order of their names; files without a record are left out."""
    files = sorted(plain_path(spark, f) for f in spark.read.text(path).inputFiles())

    def header(file: str) -> str:
        size = HEADER_BYTES
        while True:
            raw = _first_bytes(spark, file, size)
            record, whole = _first_record(raw.decode("utf-8", "replace"))
            if whole or len(raw) < size:
                return record
            size *= 8

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        for file, first in zip(files, pool.map(header, files)):
            if first.strip():
                groups.setdefault(first, []).append(file)
    return groups


def _first_record(text: str) -> tuple[str, bool]:
    """(first record that is not blank, whether its end was seen): a line break inside quotes does not end it."""
    text = text.removeprefix("\ufeff").lstrip("\r\n")
    quoted = False
    for i, c in enumerate(text):
        if c == '"':
            quoted = not quoted
        elif c in "\r\n" and not quoted:
            return text[:i], True
    return text, False


def require(missing: DataFrame) -> None:
    """Raise, naming columns and files, if a file lacks a column. At most ``NAMED`` files are listed."""
    found = missing.groupBy("file").agg(F.sort_array(F.collect_set("column")).alias("columns")).orderBy("file").limit(
        NAMED + 1).collect()
    if found:
        columns = sorted({c for r in found for c in r["columns"]})
        files = ", ".join(f"{r['file']} {r['columns']}" for r in found[:NAMED]) + (", ..." if len(found) > NAMED else "")
        raise ValueError(f"Missing required columns: {columns} in {files}")
