"""Connected components of an edge table by alternating star contraction.

Edges (a, b) live in a DataFrame; nothing is gathered. Each round hangs every
larger neighbour of a node on its smallest neighbour (large star), then every
smaller one (small star). Minima are partial aggregates, and a node with very
many neighbours is only ever the many side of a join, which adaptive
execution splits. Rounds are checkpointed, so the plan does not grow and a
lost executor re-runs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of comparable values -> (node, root); root is the least node of the component.

    Self loops and repeated edges are harmless; no edges give no rows.
    """
    edges = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .where("a <> b").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = checkpointed(small.union(down.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct())
