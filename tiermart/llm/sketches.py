"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch holds every shingle hash below a fixed fraction of the hash range,
and the least hash, so that no text with words has an empty one. The fraction
does not depend on the document: sketches of parts merge to the sketch of the
whole, and the containment of a short text in a very long one can be estimated.

Words are runs of anything but white space, lower-cased; a shingle is five words in
a row, or the whole sequence of a text that has fewer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import checkpointed

SHINGLE = 5
SCALE = 8  # one hash in SCALE is retained
ROWS_PER_RANGE = 2000
MOST_RANGES = 50_000  # beyond, ranges grow instead; what is known of them is at most a few rows for each
_WHITE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hash of every shingle, in text order; null and blank texts have none."""
    words = F.filter(F.split(F.lower(text), _WHITE), lambda w: w != "")
    return F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), lambda w: F.when(
        F.size(w) <= shingle, F.array(F.xxhash64(w))).otherwise(F.transform(
            F.sequence(F.lit(1), F.size(w) - shingle + 1), lambda i: F.xxhash64(F.slice(w, i, shingle)))))


def sketch(hashes: Column, scale: int = SCALE) -> Column:
    """Sorted distinct retained hashes of an array of shingle hashes."""
    bound = -(1 << 63) + (1 << 64) // scale
    kept = F.filter(hashes, lambda h: h < F.lit(bound))
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(kept, F.array(F.array_min(hashes))))))


def merge(one: Column, other: Column) -> Column:
    """Sketch of two texts taken together, from their sketches.

    Least hashes above the bound stay in the merged sketch; they are true hashes of the whole.
    """
    return F.sort_array(F.array_union(one, other))


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of common shingles among all of both; two empty sketches are alike (1)."""
    both = F.size(F.array_union(one, other))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / both)


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of the part's shingles that the whole has; an empty part is contained (1)."""
    n = F.size(part)
    return F.when(n == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(part, whole)) / n)


def with_sketch(docs: DataFrame, text: str = "text", name: str = "sketch", shingle: int = SHINGLE,
                scale: int = SCALE) -> DataFrame:
    """``docs`` and a sketch (array<long>) of the whole text; a null text's is empty."""
    hashed = docs.withColumn("__hashes", F.flatten(shingle_hashes(F.col(f"`{text}`"), shingle)))
    return hashed.withColumn(name, F.coalesce(
        sketch(F.col("__hashes"), scale), F.array().cast("array<long>"))).drop("__hashes")


def with_next(docs: DataFrame, key: str, columns: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None,
              name: str = "next", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` and a struct of the next row's ``columns``, by ascending integer key; the last row's next is the first.

    Null keys come last, by a hash of the row, which also orders equal keys. ``prepare``
    adds columns to each row before rows move; ``columns`` may name them.

    Rows are dealt into key ranges of about ``rows_per_range`` rows, or of so many that there are about ``MOST_RANGES``: even cells
    first, then each cell with more rows by its own least and greatest key. So what is broadcast of the ranges, and ordered in one
    task, is a few numbers for at most some times ``MOST_RANGES`` of them, whatever the table's size. Each range also gets
    the first row of the one after it, so that every row meets its next in one shuffle. Rows of one key are one range.
    """
    k = F.col(f"`{key}`")
    lo, hi, total, keys = docs.agg(F.min(k).cast("double"), F.max(k).cast("double"), F.count(F.lit(1)), F.count(k)).first()
    rows_per_range = max(rows_per_range, -(-total // MOST_RANGES))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    at = k.cast("long") if keys == total else F.when(k.isNull(), tie).otherwise(k.cast("long"))
    keyed = docs.withColumns({"__null": k.isNull(), "__at": at})
    span = {False: (lo or 0.0, hi or 0.0, keys), True: (-float(1 << 63), float(1 << 63), total - keys)}

    def cell(null: bool) -> Column:
        least, most, rows = span[null]
        cells = max(1, -(-rows // rows_per_range))
        return F.least(F.floor((F.col("__at").cast("double") - least) / ((most - least) / cells or 1.0)),
                       F.lit(cells - 1))

    celled = F.when(F.col("__null"), cell(True)).otherwise(cell(False)).cast("long")
    narrow = keyed.select("__null", "__at")
    full = checkpointed(narrow.withColumn("__cell", celled).groupBy("__null", "__cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("__at").cast("double").alias("lo"),
        F.max("__at").cast("double").alias("hi")).where(F.col("n") > 2 * rows_per_range).select(
        "__null", "__cell", "lo", F.ceil(F.col("n") / rows_per_range).alias("cuts"), (F.col("hi") - F.col("lo")).alias("w")))
    fulls = full.count()
    cut = F.when(F.col("cuts").isNull() | (F.col("w") == 0), F.lit(0)).otherwise(F.least(
        F.floor((F.col("__at").cast("double") - F.col("lo")) * F.col("cuts") / F.col("w")), F.col("cuts") - 1))
    place = ["__null", "__cell", "__cut"]

    def ranged(df: DataFrame) -> DataFrame:
        if not fulls:
            return df.withColumns({"__cell": celled, "__cut": F.lit(0).cast("long")})
        dealt = df.withColumn("__cell", celled).join(F.broadcast(full), ["__null", "__cell"], "left")
        return dealt.withColumn("__cut", cut.cast("long")).drop("lo", "cuts", "w")

    firsts = checkpointed(ranged(narrow).groupBy(*place).agg(F.min("__at").alias("__at")))  # one row for each range
    last = F.max(F.struct(*place)).over(Window.partitionBy())
    back = F.coalesce(F.lag(F.struct(*place)).over(Window.orderBy(*place)), last)
    firsts = F.broadcast(firsts.select("__null", "__at", back.alias("__to")))
    sentinels = keyed.join(firsts, ["__null", "__at"]).select(
        *docs.columns, "__at", *[F.col(f"__to.{c}").alias(c) for c in place], F.lit(1).alias("__next"))
    rows = ranged(keyed).withColumn("__next", F.lit(0)).unionByName(sentinels)
    rows = rows.withColumn("__tie", tie)
    rows = prepare(rows) if prepare else rows
    order = Window.partitionBy(*place).orderBy("__next", "__at", "__tie")
    # column by column: a struct would be built before the shuffle and move every column twice
    after = F.struct(*[F.lead(F.col(f"`{c}`")).over(order).alias(c) for c in columns])
    return rows.withColumn(name, after).where("__next = 0").drop("__next", "__at", "__tie", *place)


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by as many first ones (or all) of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  scale: int = SCALE) -> DataFrame:
    """Per row: key, n_chars, edited (text), sketch, edited_sketch, next_sketch.

    A null text counts as empty: no characters, an empty sketch, an edited text that is
    empty. A lone row is its own next. Repeated rows each get a row. No rows give none.
    """
    own = docs.select(F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    paired = with_next(own, key, ["__text", "sketch"],
                       lambda rows: with_sketch(rows, "__text", "sketch", shingle, scale))
    changed = paired.select(
        F.col(f"`{key}`"), F.length("__text").cast("long").alias("n_chars"), "sketch",
        F.col("next.sketch").alias("next_sketch"), edited(F.col("__text"), F.col("next.__text")).alias("edited"))
    return with_sketch(changed, "edited", "edited_sketch", shingle, scale)
