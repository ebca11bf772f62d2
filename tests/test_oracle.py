"""Every catalogue key against its DuckDB oracle SQL (the driver's check).

Runs on sf0.001 by default (fast); set ACTUARIA_TEST_SF=/root/testdata/sf0.01
for the driver's scale.  Values are compared exactly, columns sorted by name.
"""

import os
from collections import Counter

import duckdb
import pytest

SF = os.environ.get("ACTUARIA_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _keys():
    from actuaria.oracle import oracle_sql
    from actuaria.plans.catalogue import catalogue as queries

    sql = oracle_sql()
    return [k for k in queries() if k in sql]


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    from actuaria.oracle import oracle_sql
    from actuaria.plans.catalogue import catalogue as queries

    df = queries()[key](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[key])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_every_key_has_oracle_or_is_listed():
    from actuaria.oracle import oracle_sql
    from actuaria.plans.catalogue import catalogue as queries

    missing = set(queries()) - set(oracle_sql())
    assert not missing


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["territory_id", "town", "county"]
