"""Removal of repeated runs of lines by winnowing.

A document is its lines' hashes (white space at a line's ends does not
count). The window at a line is the least run of lines from there that has
``least_chars`` characters, or ``most_lines`` lines; it has no window if the
document ends before. The window's content hash stands for its first line. Of the
content hashes of the lines in each window the least is selected as
fingerprint, the first one on a tie: two places with the same content select
alike, so a shared run of twice ``least_chars``, or a single shared line of
``least_chars``, is sure to share a fingerprint.

Every fingerprint is joined to the earliest place that selected it (by key,
nulls last, then position). From there both places are compared line by line
in both directions, up to ``most_lines`` lines beyond the window: within that
distance a longer shared run has its next fingerprint. The lines that agree
are a later repeated run and go. A removed line always has an equal one
at an earlier place, so of every line one copy stays somewhere.

Only built-in column functions run. No pair of later places is formed: a
passage in a million documents gives a million rows. What moves is the
fingerprints and each document's text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_CHARS = 100
MOST_LINES = 16
_BLANK = " \t\r"


def _hashes(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.xxhash64(F.trim(x, F.lit(_BLANK))))


def _window_sizes(chars: Column, least_chars: int, most_lines: int) -> Column:
    """Per line, how many lines its window has; 0 for none."""
    def size(own: Column, at: Column) -> Column:
        begin = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("lines"))
        grown = F.aggregate(
            F.slice(chars, at + 1, most_lines), begin,
            lambda acc, n: F.when(acc["chars"] >= least_chars, acc).otherwise(
                F.struct((acc["chars"] + n).alias("chars"), (acc["lines"] + 1).alias("lines"))),
            lambda acc: F.when((acc["chars"] >= least_chars)
                               | ((acc["lines"] == most_lines) & (acc["chars"] >= most_lines)), acc["lines"])
            .otherwise(F.lit(0)))
        return F.when(own >= least_chars, F.lit(1)).otherwise(grown)
    return F.transform(chars, size)


def _agreeing(one: Column, other: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Equal rows (key and text) have equal identities and are treated as one document."""
    return docs.withColumns({
        "__doc": F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")),
        "__chars": F.coalesce(F.length(F.col(f"`{text}`")), F.lit(-1))})


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                 most_lines: int = MOST_LINES) -> DataFrame:
    """Selected window minima: document identity, ``at`` (first line, from 0), ``size``, ``hash`` and the
    hashes of up to ``most_lines`` lines ``before`` (nearest first) and ``after`` the window."""
    lines = _identified(docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text")),
                        "__key", "__text").select(
        "__key", "__doc", "__chars", F.split("__text", "\n", -1).alias("l"))
    hashed = lines.select("__key", "__doc", "__chars", _hashes(F.col("l")).alias("h"),
                          F.transform("l", lambda x: F.length(F.trim(x, F.lit(_BLANK)))).alias("n"))
    sized = hashed.withColumn("w", _window_sizes(F.col("n"), least_chars, most_lines))
    content = sized.withColumn("g", F.transform("w", lambda w, i: F.when(
        w > 0, F.xxhash64(F.slice("h", i + 1, w)))))

    def least(w: Column, i: Column) -> Column:
        return F.when(w == 1, i).when(w > 1, F.array_min(F.transform(
            F.sequence(i, i + w - 1),
            lambda j: F.when(F.get("g", j).isNotNull(), F.struct(F.get("g", j).alias("g"), j.alias("j")))))["j"])

    picked = content.withColumn("at", F.explode(F.array_compact(F.array_distinct(F.transform("w", least)))))
    size = F.get("w", F.col("at"))
    first = F.greatest(F.col("at") - most_lines, F.lit(0))
    return picked.select(
        "__key", "__doc", "__chars", "at", size.alias("size"), F.get("g", F.col("at")).alias("hash"),
        F.reverse(F.slice("h", first + 1, F.col("at") - first)).alias("before"),
        F.slice("h", F.col("at") + size + 1, most_lines).alias("after"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                  most_lines: int = MOST_LINES) -> DataFrame:
    """(__doc, __chars, __runs): per document the later repeated runs, disjoint and ascending [(first, last)]."""
    marks = fingerprints(docs, key, text, least_chars, most_lines)
    place = F.struct(F.col("__key").isNull().alias("none"), "__key", "__doc", "at", "before", "after")
    earliest = marks.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")).where("n > 1")
    later = marks.join(earliest, "hash").where(~((F.col("p.__doc") == F.col("__doc")) & (F.col("p.at") == F.col("at"))))
    runs = later.select(
        "__doc", "__chars",
        (F.col("at") - _agreeing(F.col("before"), F.col("p.before"))).alias("a"),
        (F.col("at") + F.col("size") - 1 + _agreeing(F.col("after"), F.col("p.after"))).alias("b")).distinct()
    doc = Window.partitionBy("__doc", "__chars").orderBy("a", "b")
    reach = F.max("b").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = runs.withColumn("new", (reach.isNull() | (F.col("a") > reach + 1)).cast("int")) \
                  .withColumn("island", F.sum("new").over(doc))
    merged = islands.groupBy("__doc", "__chars", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.groupBy("__doc", "__chars").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("__runs"))


def remove_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                          most_lines: int = MOST_LINES) -> DataFrame:
    """``docs`` with ``text`` less its later repeated runs, and n_lines, n_removed (lines).

    Null texts stay null with no lines; empty and short texts have no window and
    stay as they are; rows that repeat key and text are one document and are
    treated alike; no rows give none. Input columns n_lines and n_removed are replaced.
    """
    found = repeated_runs(docs, key, text, least_chars, most_lines)
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    both = _identified(docs.select(*[F.col(f"`{c}`") for c in names]), key, text).join(
        found, ["__doc", "__chars"], "left")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)

    def kept(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get("__runs", i - 1)["b"] + 1)
        end = F.when(i == F.size("__runs"), F.size("__lines")).otherwise(F.get("__runs", i)["a"])
        return F.slice("__lines", begin + 1, end - begin)

    cut = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("__runs")), kept)), "\n")
    split = both.withColumn("__lines", lines)
    return split.select(
        *[F.when(F.col("__runs").isNull(), F.col(f"`{c}`")).otherwise(cut).alias(c) if c == text else F.col(f"`{c}`")
          for c in names],
        F.when(F.col("__lines").isNull(), F.lit(0)).otherwise(F.size("__lines")).alias("n_lines"),
        F.when(F.col("__runs").isNull(), F.lit(0)).otherwise(F.aggregate(
            "__runs", F.lit(0), lambda acc, r: acc + r["b"] - r["a"] + 1)).alias("n_removed"))
