"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Null texts, empty texts and an empty table go
through every stage; what a stage does with them is in its operator's docstring.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.llm import decontaminate, lines, mixing, simhash, toxicity
from tiermart.llm.common import DOCUMENT_COLUMNS, shared_folder, strict_columns, table
from tiermart.llm.queries import toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    docs = strict_columns(docs, *DOCUMENT_COLUMNS)
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return strict_columns(scored.where(~F.col("rejected")), *DOCUMENT_COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their later repeated runs of lines; a document of which nothing but white space is left goes."""
    kept = lines.remove_repeated_lines(strict_columns(docs, *DOCUMENT_COLUMNS))
    kept = kept.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    kept = kept.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))
    return strict_columns(kept, *DOCUMENT_COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.keep_representatives(strict_columns(docs, *DOCUMENT_COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.clean(strict_columns(docs, *DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with size, source_size, target and taken (words, repeats counted)."""
    return mixing.mix(strict_columns(docs, *DOCUMENT_COLUMNS)).where(F.col("taken") > 0)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

# Fitted models, fingerprints and alignments have no SQL form; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result but the last is written to the shared folder and reread."""
    root = shared_folder(spark, f"corpus_pipeline/{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{n}_{name}")
        docs = spark.read.parquet(f"{root}/{n}_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
