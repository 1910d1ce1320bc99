"""Frame-level helpers with the reference's null semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Strftime directives and their Java DateTimeFormatter equivalents.
STRFTIME_TO_JAVA = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm",
    "S": "ss", "f": "SSSSSS", "3f": "SSS", "6f": "SSSSSS", ".f": "[.SSSSSS]", ".3f": ".SSS", ".6f": ".SSSSSS", "p": "a",
    "b": "MMM", "h": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD", "z": "Z", "Z": "z",
    "F": "yyyy-MM-dd", "T": "HH:mm:ss", "R": "HH:mm", "D": "MM/dd/yy", "%": "%",
}


def java_pattern(fmt: str) -> str:
    """Translate a strftime pattern to a Spark datetime pattern; text is quoted, an unknown directive raises."""
    out, text, i = [], "", 0

    def flush() -> None:
        nonlocal text
        if text:
            plain = all(not ch.isalpha() and ch not in "'[]{}#" for ch in text)
            out.append(text if plain else "'" + text.replace("'", "''") + "'")
            text = ""

    while i < len(fmt):
        if fmt[i] != "%":
            text += fmt[i]
            i += 1
            continue
        name = next((fmt[i + 1:i + 1 + n] for n in (3, 2, 1) if fmt[i + 1:i + 1 + n] in STRFTIME_TO_JAVA), None)
        if name is None:
            raise ValueError(f"unsupported datetime directive {fmt[i:i + 2]!r} in {fmt!r}")
        if name == "%":
            text += "%"
        else:
            flush()
            out.append(STRFTIME_TO_JAVA[name])
        i += 1 + len(name)
    flush()
    return "".join(out)


def to_datetime(c, fmt: str) -> Column:
    """Strict text -> timestamp (no zone); a non-matching value raises under ANSI."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp_ntz(col, F.lit(java_pattern(fmt)))


def to_date(c, fmt: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.to_date(col, java_pattern(fmt))


def fill_numeric(df: DataFrame, value: int = 0) -> DataFrame:
    """Fill nulls in numeric columns only (strings and booleans stay null)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not numeric:
        return df
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(value).cast(df.schema[c].dataType))
                           for c in numeric})


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; map-side partial de-dup before the shuffle."""
    return df.dropDuplicates()


def sort_desc(df: DataFrame, *cols: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Descending sort with nulls first (the reference's default).

    ``then`` adds ascending tiebreakers (e.g. a key): a range partitioner
    cannot split rows with equal sort keys, so heavy ties would otherwise
    land in one task.
    """
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in cols], *[F.col(c).asc_nulls_first() for c in then])


def sort_asc(df: DataFrame, *cols: str, then: tuple[str, ...] = ()) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in (*cols, *then)])


def order_faults(stored: DataFrame, keys: list[str]) -> DataFrame:
    """One row about a stored table that is meant to be in ascending order of ``keys``, nulls first: (inversions, overlaps, rows).

    ``stored`` is read from Parquet files as they are. Inversions are rows less than the row before them in their file;
    overlaps are files whose least key is less than the greatest of the file before it, by name (a writer numbers
    its files in order). Both 0: the whole table is sorted. A file is what one task looks at; then there is a row for each file.
    """
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = rows.withColumn("inverted", F.coalesce(F.col("key") < before, F.lit(False))).groupBy("file").agg(
        F.count_if("inverted").alias("inversions"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("least"),
        F.max("key").alias("most"))
    overlaps = F.coalesce(F.col("least") < F.lag("most").over(Window.orderBy("file")), F.lit(False))
    return files.withColumn("overlaps", overlaps).agg(
        F.coalesce(F.sum("inversions"), F.lit(0)).alias("inversions"), F.count_if("overlaps").alias("overlaps"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def stamp(df: DataFrame, name: str, as_of: str) -> DataFrame:
    """Constant ISO-8601 stamp column; replaces in place if it exists."""
    return df.withColumn(name, F.lit(as_of))
