"""Queries that have SQL, against it, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from shelfmark.llm.queries import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    cursor = con.execute(ORACLE[name])
    places = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(places) == names
    theirs = sorted((tuple(r[places[n]] for n in names) for r in cursor.fetchall()), key=repr)
    assert len(ours) > 0 and ours == theirs
