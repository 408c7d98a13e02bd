"""All registered queries with an oracle vs DuckDB on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from quillstream.plans import registry
from quillstream.plans.oracle import SQL
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
ALL = sorted(name for name in SQL if name in registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return c


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    exp = rows_of(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_temperature_c" in df.columns
