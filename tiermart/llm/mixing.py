"""Mixing sources to target weights.

Every row gets a hash-random key; each source is sorted by that key and cut at
its exact budget of words, whole passes first:

* Sizes are words, runs of anything but ASCII white space (null: 0).
* Sources in code-point order, null last, weigh 5, 2, 1 and so on again. They
  share all words by weight; a target above ``most`` times its source stops
  there and the excess is shared again by weight, until none is above.
* A source takes floor(target / size) whole passes over all its rows and cuts
  one more pass at the remaining words: rows before the cut go in once more,
  the row at the cut goes in with the words that are left.

The range sort needs no sampling: keys are uniform, so a key's range within
its source is arithmetic. A source is cut into as many ranges as it has
``rows_per_range`` rows; the running sum of the
ranges' totals (one row for each range) tells the range in which a source's cut lies, and only that range's
rows are sorted, each key once, to find the key of the cut. Every row then compares its own key with its source's cut: rows and
texts are not moved. A source with a third of all rows has proportionally many ranges, and one cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import checkpointed

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
ROWS_PER_RANGE = 10_000
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"

# Names no input column is likely to have; the operator's own columns while it runs.
_SIZE, _KEY, _SOURCE, _NONE = "__mix_size", "__mix_key", "__mix_source", "__mix_none"


def word_count(text: Column) -> Column:
    """Runs of non-white-space; each is folded to one mark and the rest dropped."""
    marks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size) -> adds target (double).

    Raising a common level until the shares add up gives what repeated sharing
    ends with: target = min(most * size, level * weight). The table has one row
    for each source; its two running sums go by source and by cap / weight.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("__rank"), F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("__rank", F.row_number().over(by_name) - 1).withColumn("__w", w)
    ranked = ranked.withColumn("__cap", F.col("source_size") * F.lit(float(most))) \
                   .withColumn("__at", F.col("__cap") / F.col("__w"))
    by_cap = Window.orderBy("__at", "__rank")
    up_to = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("__cap").over(up_to), F.lit(0.0))) / \
        (F.sum("__w").over(everyone) - F.coalesce(F.sum("__w").over(up_to), F.lit(0.0)))
    # In order of cap / weight, the first source that its share does not fill sets the level for all later ones.
    open_level = F.min(F.when(F.col("__level") < F.col("__at"), F.struct("__at", "__rank", "__level"))).over(everyone)
    capped = ranked.withColumn("__level", level).withColumn("__open", open_level)
    return capped.select(
        *sources.columns,
        F.when(F.col("__open").isNull(), F.col("__cap"))
        .otherwise(F.least(F.col("__cap"), F.col("__open.__level") * F.col("__w"))).alias("target"))


def mix(docs: DataFrame, keep: tuple[str, ...] | None = None, text: str = "text", source: str = "source",
        identity: tuple[str, ...] = ("doc_id", "text"), weights: tuple[float, ...] = WEIGHTS, most: float = MOST,
        rows_per_range: int = ROWS_PER_RANGE, salt: int = 0) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, and size, source_size, target, taken.

    ``taken`` counts the words that the mix takes of the row, repeats included:
    whole passes times size, plus size, a part of it, or nothing. A null or empty
    text has size 0 and is never taken; null sources are one source, the last.
    Equal rows share a key and are treated alike: if the cut falls on them, each gives its share. Keys hash ``identity`` and
    ``salt`` only, so reruns agree. Input columns named like an output are replaced. No rows give none.
    """
    names = [c for c in (keep or docs.columns) if c.lower() not in ("size", "source_size", "target", "taken")]
    own = [_SOURCE, _NONE, _SIZE, _KEY]
    sized = docs.select(
        *[F.col(f"`{c}`") for c in names],
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias(_SOURCE), F.col(f"`{source}`").isNull().alias(_NONE),
        word_count(F.col(f"`{text}`")).alias(_SIZE),
        F.xxhash64(F.lit(salt), *[F.col(f"`{c}`") for c in identity]).alias(_KEY))
    # Kept for the steps below without the texts: sizes and keys of a row are the same when they are computed again.
    narrow = checkpointed(sized.select(*own) if text in names else sized)
    sized = sized if text in names else narrow

    totals = narrow.groupBy(_SOURCE, _NONE).agg(F.sum(_SIZE).alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    plan = checkpointed(source_targets(
        totals.withColumn("source", F.when(~F.col(_NONE), F.col(_SOURCE))), weights, most).select(
        _SOURCE, _NONE, "source_size", "target", F.ceil(F.col("__rows") / rows_per_range).alias("__ranges")))
    few = plan.count() <= BROADCAST_SOURCES  # one row for each source; beyond the bound both sides are shuffled

    # uniform in [0, 1): the key's range within its source, and its place in the sort
    unit = F.shiftrightunsigned(F.col(_KEY), 11) / F.lit(float(1 << 53))
    rank = [F.shiftrightunsigned(F.col(_KEY), 11), F.col(_KEY)]
    piece = [_SOURCE, _NONE, "__range"]
    earlier = (Window.unboundedPreceding, -1)

    def planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(plan) if few else plan, [_SOURCE, _NONE])

    def running(rows: DataFrame, words: str, *order: Column) -> Column:
        return F.coalesce(F.sum(words).over(Window.partitionBy(_SOURCE, _NONE).orderBy(*order).rowsBetween(*earlier)), F.lit(0))

    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("__passes", passes).withColumn(
        "__left", F.floor(F.col("target")) - F.col("__passes") * F.col("source_size"))
    placed = planned(narrow.select(*own), plan).withColumn("__range", F.floor(unit * F.col("__ranges")))
    ranges = placed.groupBy(*piece, "__left").agg(F.sum(_SIZE).alias("__words"))
    ranges = ranges.withColumn("__before", running(ranges, "__words", F.col("__range")))
    crossed = ranges.where((F.col("__before") <= F.col("__left")) & (F.col("__left") < F.col("__before") + F.col("__words")))
    crossed = crossed.select(*piece, "__before")  # one row a source at most
    keys = placed.join(F.broadcast(crossed) if few else crossed, piece).groupBy(_SOURCE, _NONE, _KEY, "__left", "__before").agg(
        F.sum(_SIZE).alias("__words"))
    keys = keys.withColumn("__rest", F.col("__left") - F.col("__before") - running(keys, "__words", *rank))
    cut = keys.where((F.col("__rest") >= 0) & (F.col("__rest") < F.col("__words"))).select(
        _SOURCE, _NONE, F.col(_KEY).alias("__cut"), "__rest", "__words")
    plan = checkpointed(plan.join(F.broadcast(cut) if few else cut, [_SOURCE, _NONE], "left"))

    cut_place = F.shiftrightunsigned(F.col("__cut"), 11)
    first = (rank[0] < cut_place) | (rank[0] == cut_place) & (F.col(_KEY) < F.col("__cut"))
    part = F.when(F.col("__cut").isNull(), F.lit(0)).when(F.col(_KEY) == F.col("__cut"), F.floor(
        F.col(_SIZE) * F.col("__rest").cast("decimal(38,0)") / F.col("__words"))).when(first, F.col(_SIZE)).otherwise(F.lit(0))
    return planned(sized, plan).select(
        *[F.col(f"`{c}`") for c in names], F.col(_SIZE).alias("size"), "source_size", "target",
        (F.col("__passes") * F.col(_SIZE) + part).cast("long").alias("taken"))
