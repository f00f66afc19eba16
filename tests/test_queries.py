"""Every query against its SQL on the smallest tables."""

import datetime
import decimal
import os

import pytest

from fairweave.plans.fixtures import TABLES
from fairweave.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are absent")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda xs: sorted(repr(tuple(map(plain, x))) for x in xs)
    assert rows(got.select(columns).collect()) == rows(found.fetchall())
