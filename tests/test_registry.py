"""Every registered query against the same result in SQL."""

import os

import duckdb
import pytest

from navspark.plans.registry import QUERIES, SQL


def norm(row):
    return tuple(repr(round(x, 6)) if isinstance(x, float) else str(x) for x in row)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, db, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    rows = sorted(norm(r) for r in got.select(*columns).collect())
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(norm([r[i] for i in at]) for r in found.fetchall())


def test_entry_module(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql())
