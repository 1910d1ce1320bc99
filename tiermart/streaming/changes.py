"""What changed between two snapshots of a table, and tables brought up to date from that alone.

``changed_keys`` compares two batches by key: per key the number of its rows and two sums of row hashes, so
that repeated rows and rows in any order compare as they should. Both sides are reduced to one small row a key by partial
aggregates before they meet. Stamps are left out of the hash: a row that landed again as it was is not a change.

Cleaning is row by row, so ``refresh_clean`` cleans only rows of new and changed keys and keeps the others as they were
cleaned before, with their stamps. A mart row hangs on the rows of its group alone, so ``refresh_groups`` builds
only groups that had or have a changed row. ``refresh_customer_risk`` does the same for a mart over three tables:
a customer is touched by a change of its own, of a policy that it had or has, or of a claim on one. What is kept is the
old batch's; the result equals a full rebuild but for the stamps of what was kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.plans import gold, silver

STAMPS = ("fetched_at", "transformed_at", "aggregated_at")
NEW, CHANGED, GONE = "new", "changed", "gone"


def keep(rows: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) a match in ``keys``; null keys match too."""
    keys = keys.select(*[F.col(c).alias(f"__key{i}") for i, c in enumerate(columns)]).distinct()
    return rows.join(keys, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(columns)]), how)


def changed_keys(old: DataFrame, new: DataFrame, key: list[str], ignore: tuple[str, ...] = STAMPS) -> DataFrame:
    """(key columns, change): the keys whose rows are not the same in both; change is new, changed or gone.

    Columns are compared by name; a column that one side does not have is null there.
    """
    names = sorted({*old.columns, *new.columns} - {*key, *ignore})

    def state(rows: DataFrame, side: str) -> DataFrame:
        values = [F.to_json(F.struct(F.col(f"`{n}`").alias("v"))) if n in rows.columns else F.lit("{}") for n in names]
        sums = [F.sum(F.xxhash64(F.lit(salt), *values).cast("decimal(38,0)")).alias(f"{side}{salt}") for salt in (1, 2)]
        return rows.groupBy(*[F.col(k).alias(f"{side}key{i}") for i, k in enumerate(key)]).agg(
            F.count(F.lit(1)).alias(f"{side}n"), *sums)

    matched = reduce(lambda x, y: x & y, [F.col(f"oldkey{i}").eqNullSafe(F.col(f"newkey{i}")) for i in range(len(key))])
    joined = state(old, "old").join(state(new, "new"), matched, "full")
    same = reduce(lambda x, y: x & y, [F.col(f"old{c}") == F.col(f"new{c}") for c in ("n", 1, 2)])
    change = F.when(F.col("oldn").isNull(), NEW).when(F.col("newn").isNull(), GONE).when(~same, CHANGED)
    # A side that has no such rows has null keys, the other one's are the key.
    return joined.select(*[F.coalesce(f"newkey{i}", f"oldkey{i}").alias(k) for i, k in enumerate(key)],
                         change.alias("change")).where("change is not null")


def refresh_clean(table: str, silver_old: DataFrame, bronze_new: DataFrame, changes: DataFrame, key: list[str],
                  as_of: str) -> tuple[DataFrame, DataFrame]:
    """(the cleaned table of the new snapshot, the rows of it that were cleaned now)."""
    todo = keep(bronze_new, changes.where(F.col("change") != GONE), key)
    cleaned = silver.clean(table, todo, as_of)
    kept = keep(silver_old, changes, key, "left_anti")
    return kept.unionByName(cleaned, allowMissingColumns=True), cleaned


def refresh_groups(mart_old: DataFrame, rows_old: DataFrame, rows_new: DataFrame, changes: DataFrame, key: list[str],
                   group: list[str], build: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(the mart over ``rows_new``, the groups of it that were built now). ``build`` makes a mart row of each group's rows."""
    touched = keep(rows_old, changes, key).select(group).union(
        keep(rows_new, changes.where(F.col("change") != GONE), key).select(group)).distinct()
    built = build(keep(rows_new, touched, group))
    return keep(mart_old, touched, group, "left_anti").unionByName(built), built


def refresh_claims_summary(mart_old: DataFrame, claims_old: DataFrame, claims_new: DataFrame, changes: DataFrame,
                           as_of: str) -> tuple[DataFrame, DataFrame]:
    """G1 for the new claims; groups are rebuilt where a claim came, went or changed."""
    return refresh_groups(mart_old, claims_old, claims_new, changes, ["claim_id"], ["claim_type", "status"],
                          lambda rows: gold.claims_summary(rows, as_of))


def refresh_customer_risk(mart_old: DataFrame, old: dict[str, DataFrame], new: dict[str, DataFrame],
                          changes: dict[str, DataFrame], as_of: str) -> tuple[DataFrame, DataFrame]:
    """G4 for the new tables; ``old`` and ``new`` are the cleaned customers, policies and claims, ``changes`` by table."""
    customer, policy = ["customer_id"], ["policy_id"]

    def of_changed(table: str, key: str, columns: list[str]) -> DataFrame:
        return reduce(DataFrame.union, [keep(side[table], changes[table], [key]).select(columns) for side in (old, new)])

    claimed = of_changed("claims", "claim_id", policy).distinct()
    # A claim on a policy number counts for every policy that has it, and their number counts too.
    numbers = of_changed("policies", "policy_id", policy).union(claimed).distinct()
    owners = reduce(DataFrame.union, [keep(side["policies"], numbers, policy).select(customer) for side in (old, new)])
    touched = changes["customers"].select(customer).union(owners).distinct()
    customers = keep(new["customers"], touched, customer)
    own = keep(new["policies"], touched, customer).select(policy)
    policies = keep(new["policies"], own, policy)
    built = gold.customer_risk_from_clean(customers, policies, keep(new["claims"], own, policy), as_of)
    return keep(mart_old, touched, customer, "left_anti").unionByName(built), built
