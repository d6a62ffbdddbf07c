"""The queries that DuckDB SQL can express, against it on the smallest tables."""

import duckdb
import pytest

from viewlog.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    got = queries.registry()[name](spark, FOLDER)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
