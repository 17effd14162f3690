"""Registered queries against their SQL on the smallest tables, and the shape of their plans."""

import ast
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tabforge.plans import catalog
from tools.check import TABLES, compare

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_no_helper_replaces_another():
    """A name bound twice in the catalog would give the first function's callers the second."""
    tree = ast.parse(Path(catalog.__file__).read_text())
    names = Counter(n.name for n in tree.body if isinstance(n, (ast.FunctionDef, ast.ClassDef)))
    assert [n for n, times in names.items() if times > 1] == []


def test_missing_values_are_those_of_lineitem(spark, sf):
    names = {r.column_name for r in QUERIES["missing_values"](spark, sf).collect()}
    assert names == {"tax", "quantity", "status"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert compare(got, duck.execute(ORACLE[name]).df()).startswith("ok")
    assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 11


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "outlier_chain", "outlier_summary", "fe_base", "ratios", "drop_duplicates", "mode_share",
    "pearson", "trend_r2", "describe", "avg_rank", "zero_flags", "fold_assign"])
def test_no_python_and_no_cross_product(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "MapInPandas",
                "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_scan_reads_only_needed_columns(spark, sf):
    df = QUERIES["drop_duplicates"](spark, sf)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan(df), text


def test_row_flags_need_no_shuffle(spark, sf):
    """Policies, flags and folds are projections and filters over the scan."""
    from tabforge.plans.folds import with_folds
    from tabforge.sources.readers import read_table
    df = with_folds(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 6, 5)
    assert "Exchange" not in plan(df)
