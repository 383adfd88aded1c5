"""Every registered query against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from masterline.plans import catalogue, catalogue_flows  # noqa: F401  the latter adds to the former's queries


def value(x):
    return float(x) if type(x).__name__ in ("Decimal", "float") else x


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, sf, con, name):
    got = catalogue.QUERIES[name](spark, sf)
    quoted = ", ".join(f'"{c}"' for c in sorted(got.columns))
    want = con.execute(f"SELECT {quoted} FROM ({catalogue.SQL[name]})").fetchall()
    mine = [tuple(map(value, r)) for r in got.select(*sorted(got.columns)).collect()]
    assert sorted(map(repr, mine)) == sorted(repr(tuple(map(value, r))) for r in want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["global_supplier_id", "supplier_name", "n_lines", "n_forms", "total_spend"] and out.count() > 0


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = catalogue.po_lines(spark, sf).filter("line_id > 5").select("line_id", "amount")._jdf.queryExecution().executedPlan().toString()
    lineitem = next(x for x in plan.split("\n") if "l_extendedprice" in x and "FileScan" in x)
    assert "l_comment" not in lineitem and "l_shipdate" not in lineitem and "IsNotNull(l_suppkey)" in lineitem


@pytest.mark.parametrize(("name", "most"), [("best_original", 25), ("supplier_aggregate", 13), ("supplier_master", 13)])
def test_names_are_cleaned_once_and_after_they_are_counted(spark, sf, name, most):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count("regexp_replace(") <= most
    # nothing below the lowest grouping, whose inputs are joins of the tables, is cleaned
    lines = plan.split("\n")
    lowest = max(i for i, x in enumerate(lines) if "Aggregate [" in x)
    assert not any("regexp_replace(" in x.lower() for x in lines[lowest + 1 :])


def test_entity_rules_compute_tokens_once(spark, sf):
    plan = catalogue.QUERIES["entity_counts"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count("regexp_replace(") <= 20
