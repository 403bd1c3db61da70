"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from shelfmark.plans.oracle import ORACLE
from shelfmark.plans.registry import QUERIES

duckdb = pytest.importorskip("duckdb")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["review_rating", "n_reviews", "percentage"] and df.count() == 5


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    names = sorted(df.columns)
    ours = sorted((tuple(map(normal, r)) for r in df.select(*names).collect()), key=repr)
    cursor = con.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    places = [list(types).index(n) for n in names]
    assert sorted(types) == names
    theirs = sorted((tuple(normal(r[i]) for i in places) for r in cursor.fetchall()), key=repr)
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema} == types
    assert len(ours) == len(theirs) > 0
    assert ours == theirs
