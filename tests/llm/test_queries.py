import os

import pytest

from fairweave.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are absent")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_packing"}))
def test_a_row_for_each_document(spark, name):
    want = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()) == want
