"""Every query with SQL against DuckDB, and the contract's functions."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from snapstate.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def text_of(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return repr(float(v)) if isinstance(v, float) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(text_of(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = catalogue.queries()[name](spark, sf_dir)
    got = con.sql(catalogue.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of(got.columns, got.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_reference_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_corpus_part():
    root = Path(entry.__file__).parent / "snapstate"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"\bllm\b", p.read_text()), p
