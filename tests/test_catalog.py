"""Each query of the counting catalogue against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from tallywright.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(show(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
