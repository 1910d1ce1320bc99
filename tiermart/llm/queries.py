"""Registered corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.llm import (conversations, decontaminate, language, licenses, lines, mixing, periodic, quality, simhash,
                          sketches, tokens, toxicity, webpage)
from tiermart.llm.common import checkpointed, hash_sample, table
from tiermart.llm.oracle import ORACLE  # noqa: F401  read by the entry

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on rows of ``docs`` that ``labels`` covers; a document with several labels has the highest.

    The labelled ids are sampled before they meet any text; so bounded, they go to the documents.
    """
    labels = table(spark, sf_dir, "labels").where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    sample = hash_sample(labels, ["doc_id"], toxicity.LABELLED_ROWS)
    return toxicity.fit(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, nearest grade and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", "severity", "grade", "rejected")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return webpage.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.col("n_chars").cast("long"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an exact, edited or paraphrased copy of a benchmark item."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    learned = docs.where(~held_out & F.col("lang").isNotNull())
    model = language.train(*language.labelled_sample(learned))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without its later repeated runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), keep=("doc_id",))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document; groups are joined over links of at most three bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Words and greedy word pieces of every document."""
    first, inner = tokens.sentencepiece_entries(vocabulary)
    return tokens.count_tokens(table(spark, sf_dir, "documents"), first, inner,
                               byte_fallback=tokens.has_byte_pieces(vocabulary))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and its edited text as hex hashes, and their likeness."""
    found = sketches.edit_likeness(table(spark, sf_dir, "documents"))

    def digits(name: str):
        return F.array_join(F.transform(name, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")

    return found.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        digits("sketch").alias("fingerprint"), digits("edited_sketch").alias("edited_fingerprint"),
        sketches.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketches.containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base, spans = F.col("base.label"), F.col("spans.label")
    first = F.col("base.first")

    def joined(labels):
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(first).cast("long").alias("first_word"), F.array_max(first).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, spans)).alias("labels"),
        F.coalesce(F.array_max("spans.weight"), F.lit(0.0)).alias("score"))


def repeated_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """op11's texts: in one of ten documents, by the id's CRC-32, the words from some place on repeat the first few of them."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * (1 + (n - a) // len(period)))[:n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest one, and digests of all runs and of the text without their repeats."""
    found = periodic.find_runs(table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))))
    # The least of (-length, start, period); no run: null.
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"),
                                                             r["period"].alias("period"))))
    found = found.withColumn("top", top)
    length = -F.col("top.n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), length.alias("length"),
        F.col("top.period").alias("period"),
        F.floor(F.lit(1000) * length / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is labelled good, learned from the labelled ones that are not held out.

    A document with several labels has the highest. Texts are read once; their statistics are kept for fit and score.
    """
    def held_out():
        return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))

    rows = checkpointed(quality.described(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    labels = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    found = quality.score(rows, quality.fit(rows.join(labels, "doc_id")))
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def shared_openings(found: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """op13's conversations: each begins with as many turns (0 to ``most``, by its id's CRC-32) of its group's first one."""
    first = found.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("parts", 1, most).alias("opening"))
    turns = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = found.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % group).withColumn("turns", turns).join(
        first, "first_id", "left")
    opening = F.coalesce("opening", F.slice("parts", 1, 0))
    return joined.select("conv_id", F.concat(
        F.slice(opening, F.lit(1), F.col("turns")),
        F.slice("parts", F.col("turns") + 1, F.greatest(F.size("parts") - F.col("turns"), F.lit(0)))).alias("parts"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversations.trie(shared_openings(conversations.sequences(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_main_text": op2_main_text,
    "op3_decontamination": op3_decontamination,
    "op4_language": op4_language,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_simhash": op7_simhash,
    "op8_token_counts": op8_token_counts,
    "op9_fingerprints": op9_fingerprints,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality": op12_quality,
    "op13_prefix_trie": op13_prefix_trie,
}