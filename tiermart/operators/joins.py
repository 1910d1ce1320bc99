"""Equi-joins with predictable column naming, and a skew-tolerant left join.

Naming rule: the key appears once (taken from the left), left columns keep
their order, then the right side's non-key columns follow; a right column
whose name is already on the left gets ``_right`` appended. Spark's own
``join`` would keep both copies, so the right side is renamed *before* the
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUFFIX = "_right"


def _renamed_right(left: DataFrame, right: DataFrame, on: str, suffix: str) -> DataFrame:
    overlap = {c: c + suffix for c in right.columns if c in left.columns and c != on}
    return right.withColumnsRenamed(overlap) if overlap else right


def suffix_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", suffix: str = SUFFIX,
                strategy: str | None = None) -> DataFrame:
    """Join on one key with ``_right`` suffixes for colliding right columns.

    ``strategy`` is an optional join hint (e.g. ``"shuffle_merge"``).
    """
    r = _renamed_right(left, right, on, suffix)
    joined = (left.hint(strategy) if strategy else left).join(r, on=on, how=how)
    return joined.select(*[F.col(f"`{c}`") for c in left.columns],
                         *[F.col(f"`{c}`") for c in r.columns if c != on])


def left_join_skew_safe(left: DataFrame, right: DataFrame, on: str, suffix: str = SUFFIX,
                        strategy: str | None = None) -> DataFrame:
    """Left outer join that tolerates a hot key on the *right* (many) side.

    Adaptive execution can split a skewed partition of the streamed (left)
    side of a left outer join, but not of the right side. This rewrites
    ``left LEFT JOIN right`` as

        (left INNER JOIN right)  UNION ALL  (left ANTI JOIN distinct right keys, null-padded)
        UNION ALL (left rows without a key, null-padded)

    The inner join lets AQE split a hot key on either side; the anti join
    sees at most one row per key on the right (pre-aggregated map-side), so
    no task ever buffers a hot key's rows. Same rows as the plain left join.

    Rows without a key are taken out first: both joins then read the very same
    filtered left side, and its scan and shuffle are done once and reused.
    """
    r = _renamed_right(left, right, on, suffix)
    keyed = left.where(F.col(on).isNotNull())
    matched = suffix_join(keyed, right, on, "inner", suffix, strategy)
    keys = r.select(on).where(F.col(on).isNotNull()).distinct()
    unmatched = (keyed.hint(strategy) if strategy else keyed).join(keys, on=on, how="left_anti")
    unmatched = unmatched.select(*[F.col(f"`{c}`") for c in left.columns]).union(left.where(F.col(on).isNull()))
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields if f.name != on]
    padded = unmatched.select(*[F.col(f"`{c}`") for c in left.columns], *padding)
    return matched.unionByName(padded)
