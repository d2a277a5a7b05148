"""Every registered query against its DuckDB oracle at sf0.01 (the round gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from feedlens.plans.catalog import registry
from feedlens.plans.oracle import oracle_sql
from tools.check_oracle import digest

from fixture_paths import SF001


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF001}/events.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(registry())
    assert set(E.oracle_sql()) <= set(E.queries()) and set(registry()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = registry()[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Date", "views", "likes", "CTR", "DAU"]
    assert df.count() >= 0
