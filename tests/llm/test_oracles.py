"""Queries with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from masterline.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = registry.queries()[name](spark, sf)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))
