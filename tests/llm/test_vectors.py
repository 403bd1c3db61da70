import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, v int, rank string"


def brute(ids, x, query, k):
    scores = x @ x[ids.index(query)]
    order = sorted((-s, i) for s, i in zip(scores.tolist(), ids) if i != query)
    return [i for _, i in order[:k]]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    folder = f"/root/testdata/{sf}/embeddings.parquet"
    table = ds.dataset(folder).to_table().to_pydict()
    ids, x = table["vec_id"], np.array(table["embedding"], float)
    got = {}
    for r in vectors.nearest(spark.read.parquet(folder), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r
    queries = [i for i in ids if i % 20 == 0]
    assert set(got) == set(queries)
    shares = []
    for q in queries:
        rows = [got[q][i] for i in range(1, 21)]
        shares.append(len({r["vec_id"] for r in rows} & set(brute(ids, x, q, 20))) / 20)
        assert [-r["score"] for r in rows] == sorted(-r["score"] for r in rows)
        for r in rows[:3]:
            assert r["score"] == pytest.approx(float(x[ids.index(r["vec_id"])] @ x[ids.index(q)]), abs=1e-12)
    assert np.mean(shares) >= 0.9


def test_norms_count(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.2, 3, size=(900, 1))
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(x)], SCHEMA.replace("float", "double"))
    monkeypatch.setattr(vectors, "BLOCK", 200)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 20)
    got = {}
    for r in vectors.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    shares = [len(set(got[q]) & set(brute(list(range(900)), x, q, 10))) / 10 for q in got]
    assert len(got) == 45 and np.mean(shares) >= 0.9


def test_footrule():
    rng = np.random.default_rng(2)
    own = np.array([rng.permutation(12)[:5] for _ in range(60)])
    asked = np.array([rng.permutation(12)[:5] for _ in range(9)])

    def places(order):
        full = np.full(12, 5)
        full[order] = np.arange(5)
        return full

    files = vectors.Files(own.astype(np.int32), 2)
    for q in asked:
        distance = [np.abs(places(q) - places(o)).sum() for o in own]
        assert files.footrule(q, np.arange(60)).tolist() == distance
        assert files.footrule(q, np.array([3, 50])).tolist() == [distance[3], distance[50]]
        assert files.posted(q[:3]).tolist() == [i for i, o in enumerate(own) if set(o[:2]) & set(q[:3])]
    assert files.posted(np.array([99])).tolist() == []


def test_units_are_bounded():
    counts = np.array([5, 3, 30, 2, 9, 0, 11])
    first, parts = vectors.units_of(counts, np.arange(7), 10)
    held = {}
    for f, p, c in zip(first, parts, counts):
        for u in range(p):
            held[f + u] = held.get(f + u, 0) + c / p
    assert max(held.values()) <= 10 and parts.tolist() == [1, 1, 3, 1, 1, 1, 2]


def test_clusters_open_few_files(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 6000)] + 0.25 * rng.normal(size=(6000, 24))
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(x)], SCHEMA.replace("float", "double"))
    monkeypatch.setattr(vectors, "BLOCK", 500)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 16)
    opened, deal = [], vectors.Index.deal
    monkeypatch.setattr(vectors.Index, "deal", lambda index, points: (opened.append(index.opened / len(index.pivots)), deal(index, points)))
    got = {}
    for r in vectors.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    shares = [len(set(got[q]) & set(brute(list(range(6000)), x, q, 20))) / 20 for q in got]
    assert len(got) == 300 and all(len(v) == 20 for v in got.values()) and np.mean(shares) >= 0.9
    assert opened[0] < 0.3


def test_repeated_ids_with_different_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i % 60, rng.normal(size=4).tolist(), 1, "a") for i in range(180)]
    got = {}
    for r in vectors.nearest(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert sorted(got) == [0, 20, 40]
    for q, found in got.items():
        assert len(found) == len({i for _, i in found}) == 20 and sorted(found) == found and q not in {i for _, i in found}


def test_odd_vectors_ties_and_few(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1, "a"),
        (2, [1.0, 0.0], 1, "a"),
        (1, [1.0, 0.0], 1, "a"),
        (1, [1.0, 0.0], 1, "a"),
        (20, [0.0, 1.0], 1, "a"),
        (3, None, 1, "a"),
        (4, [0.0, 0.0], 1, "a"),
        (5, [nan, 1.0], 1, "a"),
        (6, [inf, 1.0], 1, "a"),
        (7, [None, 1.0], 1, "a"),
        (8, [1.0, 2.0, 3.0], 1, "a"),
        (9, [], 1, "a"),
        (None, [1.0, 1.0], 1, "a"),
        (40, None, 1, "a"),
    ]
    got = vectors.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)
    ]
    assert vectors.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert vectors.nearest(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0], 1, "a") for i in range(300)]
    got = vectors.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).filter("query_id = 20").orderBy("rank").collect()
    x = np.array([r[1] for r in rows])
    assert [r["vec_id"] for r in got] == brute(list(range(300)), x, 20, 20)
