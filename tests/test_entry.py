"""Driver contract: entry runs; every query has a name-matched oracle (checked at sf0.01 by tools)."""

import pytest

import __spark_entry__ as se
from tiermart.plans.oracle import ORACLE as _ORACLE

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id" and "risk_category" in df.columns


def test_registry_and_oracle_cover_each_other():
    from tiermart.plans.registry import QUERIES

    assert set(QUERIES) == set(_ORACLE)
    assert set(QUERIES) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from tools.check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(_ORACLE))
def test_query_matches_oracle(spark, duck, name):
    """Every registered query against its DuckDB SQL (the driver's gate, at the smallest scale)."""
    from tools.check_oracle import rows_of

    df = se.queries()[name](spark, SF)
    res = duck.execute(se.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, res.fetchall())
