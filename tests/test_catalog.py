"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from conftest import SF  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return connection


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in SQL])
def test_query_matches_sql(spark, con, name):
    status, note, _ = check.compare(spark, con, name, SF)
    assert status == "ok", note


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SQL and not n.startswith("ml")])
def test_query_without_sql_has_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["id", "data_ref1"] and df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())
