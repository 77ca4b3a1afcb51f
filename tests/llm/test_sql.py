"""The corpus queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from snapstate.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = registry.queries()[name](spark, sf_dir)
    got = con.sql(registry.oracle_sql()[name])
    rows = lambda names, data: sorted(tuple(repr(r[names.index(c)]) for c in sorted(names)) for r in data)
    assert sorted(df.columns) == sorted(got.columns) and rows(df.columns, df.collect()) == rows(got.columns, got.fetchall())
