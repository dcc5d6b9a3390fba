"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tripyard.registry import QUERIES
from scripts.check_oracle import TABLES, canon
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, SF_SMALL)
    res = con.execute(contract.oracle_sql()[name])
    spark_side = canon(df.columns, [tuple(r) for r in df.collect()])
    oracle_side = canon([d[0] for d in res.description], res.fetchall())
    assert spark_side[0] == oracle_side[0]
    assert spark_side[1] == oracle_side[1]


def test_entry_smoke(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert df.columns == ["pickup_zone", "total_perjalanan", "total_revenue", "revenue_per_trip", "source_type"]
    assert len(rows) == 5
