import duckdb
import pytest

from quillstream.llm.oracle import SQL
from quillstream.llm.queries import QUERIES
from tests.llm.conftest import SF001


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF001}/{table}.parquet')")
    got = QUERIES[name](spark, SF001)
    order = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({SQL[name]})").fetchall()
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr) == sorted((tuple(r) for r in want), key=repr)
