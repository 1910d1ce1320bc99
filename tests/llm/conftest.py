import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Build a documents table from (doc_id, text[, lang[, source]]) rows."""
    def build(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:  # names that the operators use themselves, and one that clashes but for its case
            from pyspark.sql import functions as F
            for name in ("size", "taken", "Severity", "n_lines", "fp", "hash", "runs"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return build


@pytest.fixture(scope="session")
def real(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
