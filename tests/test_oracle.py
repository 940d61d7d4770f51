"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry_file
from checks import compare

QUERIES, SQL = entry_file.queries(), entry_file.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con(sf):
    return compare.sql_connection(sf)


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    kinds = {r[0]: r[1] for r in con.execute("DESCRIBE " + SQL[name]).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert compare.difference(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry_file.entry(spark).collect()
    assert len(rows) == 15
    assert rows[0]["critical"] >= rows[-1]["critical"]
