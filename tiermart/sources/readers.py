"""Landed-file readers and bronze ingestion.

Bronze keeps data as it is: every column of a landed file is read. Declared columns get their
declared type, others the file's own (text in CSV), and a changed upstream type fails at read
time instead of changing results. What columns there are is the word of every file (CSV headers,
JSON records, Parquet footers; ``tiermart.sources.census``): files of one landing may differ in order and number
of columns, a column that one of them has is kept, and a file without a required one is named in an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tiermart.operators.quality import validate
from tiermart.plans.silver import SPECS
from tiermart.sources import census, schemas

# Raw (bronze) text keeps its padding: cleaning is silver's job.
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "quote": '"',
    "escape": '"',
}


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             multi_line: bool = False) -> DataFrame:
    """CSV, columns matched by header; a malformed value, or a file with another header, fails the read.

    Standard quoting: a quote inside quotes is doubled. With ``multi_line`` quoted values may
    hold line breaks; such files cannot be split, so a file is then one task. Without a header
    the columns are ``schema``'s, in order.
    """
    options = {**CSV_OPTIONS, "header": header, "multiLine": multi_line}
    if header:  # the first line only, no pass over the data
        declared = {f.name: f for f in schema.fields}
        names = spark.read.options(**options).csv(path).columns
        schema = StructType([declared.get(n, StructField(n, StringType())) for n in names])
    return (spark.read.schema(schema).options(**options).option("enforceSchema", not header)
            .option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Land rows as CSV exactly as they are (Spark's writer trims by default)."""
    df.write.options(**CSV_OPTIONS).option("header", header).csv(path)


def read_csv_files(spark: SparkSession, path: str, schema: StructType, required: tuple[str, ...] = (),
                   multi_line: bool = False) -> DataFrame:
    """CSV files whose headers may differ: each header's files are read by it, and brought together by name.

    A column that a file does not have is null in its rows; a required one that it does not have raises.
    """
    groups = census.csv_headers(spark, path)
    if not groups:
        return spark.createDataFrame([], schema)
    options = {**CSV_OPTIONS, "header": True, "multiLine": multi_line}
    # Spark's own reading of each header: names that are blank or stand twice are made distinct.
    names = {first: spark.read.options(**options).csv(files[0]).columns for first, files in groups.items()}
    lacking = [(file, c) for first, files in groups.items() for c in required if c not in names[first] for file in files]
    if lacking:
        census.require(spark.createDataFrame(lacking, "file string, column string"))
    declared = {f.name: f for f in schema.fields}
    parts = [spark.read.schema(StructType([declared.get(n, StructField(n, StringType())) for n in names[first]]))
             .options(**options).option("enforceSchema", False).option("mode", "FAILFAST").csv(files)
             for first, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json(spark: SparkSession, path: str, schema: StructType, undeclared: bool = True) -> DataFrame:
    """JSON lines: the declared columns and, for which the records are read once more, those found beside them.

    A declared column has its declared type, also where no record holds it or all hold null; in JSON
    a key that is left out is a null. Undeclared ones have the type that their values show, inside declared
    structs too. ``undeclared=False`` reads the declared ones only.
    """
    if undeclared:
        schema = with_found(schema, spark.read.json(path).schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def with_found(declared: DataType, found: DataType) -> DataType:
    """A declared type with the fields that were found beside its own, structs and arrays of them all the way down."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        there = {f.name: f for f in found.fields}
        own = [StructField(f.name, with_found(f.dataType, there[f.name].dataType), f.nullable) if f.name in there else f
               for f in declared.fields]
        return StructType(own + [f for f in found.fields if f.name not in set(declared.names)])
    if isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(with_found(declared.elementType, found.elementType), declared.containsNull)
    return declared


def _flat_columns(schema: StructType, path: tuple[str, ...], sep: str) -> list[Column]:
    cols: list[Column] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            cols.extend(_flat_columns(field.dataType, here, sep))
        else:
            cols.append(_nested(here).alias(sep.join(here)))
    return cols


def _nested(path: tuple[str, ...]) -> Column:
    """A nested field by its path; names may hold any character."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> flat columns named ``parent<sep>child`` (arrays stay as they are).

    A projection only: no shuffle, and nested-field pruning reaches the scan. Names may contain ``sep``.
    """
    return df.select(*_flat_columns(df.schema, (), sep))


def jdbc_options(url: str, query: str, partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``: a query source, read in parallel ranges.

    Without a partition column Spark reads through one connection, so the
    bounds are required together for a parallel read of a large table.
    (Spark does not allow ``query`` together with ``partitionColumn``; the
    query then goes in as a derived table through ``dbtable``.)
    """
    if not url or not query:
        raise ValueError("url and query are required")
    options = {"url": url, "fetchsize": str(fetch_size)}
    ranged = [partition_column, lower_bound, upper_bound, num_partitions]
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        options.update({"dbtable": f"({query}) AS src", "partitionColumn": partition_column,
                        "lowerBound": str(lower_bound), "upperBound": str(upper_bound),
                        "numPartitions": str(num_partitions)})
    else:
        options["query"] = query
    options.update({k: str(v) for k, v in extra.items()})
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Strictly cast the declared columns that ``df`` has; other columns stay as they are."""
    declared = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(declared[c]).alias(c) if c in declared else F.col(f"`{c}`")
                       for c in df.columns])


def landed(spark: SparkSession, table: str, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """Landed files of one bronze table (``fetched_at`` is added at ingest): all columns of all files.

    Raises, with the files' names, if one lacks a required column: a CSV header or Parquet footer without it, or JSON
    records of which none has the key. A null value is no lack.
    """
    schema = StructType([f for f in schemas.BRONZE[table].fields if f.name != "fetched_at"])
    required = SPECS[table].required
    if fmt == "csv":
        return read_csv_files(spark, path, schema, required, multi_line)
    if fmt == "json":
        census.require(census.json_missing(spark, path, list(required)))
        return read_json(spark, path, schema)
    if fmt == "parquet":
        found = census.parquet_schema(spark, path)
        census.require(census.parquet_missing(spark, path, list(required), found))
        return conform(spark.read.schema(found).parquet(path), schema)
    raise ValueError(f"unsupported landing format {fmt!r} (csv, json, parquet)")


def ingest(df: DataFrame, table: str, as_of: str) -> DataFrame:
    """Landed rows, whole, with declared types, stamped ``fetched_at``; required columns must be there."""
    validate(df, SPECS[table].required)
    return conform(df, schemas.BRONZE[table]).withColumn("fetched_at", F.lit(as_of))
