import random

import numpy as np
from pyspark.sql import functions as F

from shelfmark.llm import toxicity as tx

WORDS = ["".join(random.Random(i).choices("bdfgklmnprst", k=2)) + "aeiou"[i % 5] + "nor" for i in range(200)]


def text(rng, toxic, n=60):
    words = rng.choices(WORDS, k=n)
    for _ in range(3 if toxic else 0):
        words[rng.randrange(n)] = rng.choice(["zwixxer", "Zwixxing", "quobble"])
    return " ".join(words)


def data(spark, n=400, held=100):
    rng = random.Random(2)
    docs = [(i, text(rng, i % 4 == 0)) for i in range(n)]
    labels = [(i, int(i % 4 == 0), 1) for i in range(n - held)]
    # Wrong labels on held-out rows; learning from them would show.
    labels += [(i, int(i % 4 != 0), 1) for i in range(n - held, n)]
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")


def test_learns_only_where_told_and_calibrates(spark):
    docs, labels = data(spark)
    model = tx.fit(docs, labels, learn=F.col("doc_id") < 300)
    rows = {r["row"]["doc_id"]: r for r in tx.with_toxicity(docs, model).collect()}
    held = [(rows[i]["score"], i % 4 == 0) for i in range(300, 400)]
    assert np.mean([(s >= 0.3) == y for s, y in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    best = rows[304]["evidence"]
    assert best and all(e["doc_id"] < 300 and 0 < e["cosine"] <= 1 for e in best)
    assert [e["cosine"] for e in best] == sorted((e["cosine"] for e in best), reverse=True)


def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    examples = [(i, int(i % 3 == 0), {int(t): int(rng.integers(1, 4)) for t in rng.choice(40, rng.integers(1, 9), replace=False)}) for i in range(500)]
    model = tx.Model([f"t{i}" for i in range(40)], rng.uniform(1, 5, 40), examples, {0: 1000, 1: 300})
    dense = np.zeros((len(model.ids), 40))
    by_id = {i: c for i, _, c in examples}
    for row, i in enumerate(model.ids.tolist()):
        ids, weights = model.vector(by_id[i])
        dense[row, ids] = weights
    for i in range(40):
        ids, weights = model.vector(by_id[i])
        cosines = dense[:, ids] @ weights
        want = sorted(((-round(float(c), 12), r) for r, c in enumerate(cosines) if c > 0 and r != 3))[:15]
        got = model.nearest(ids, weights, 15, without=3)
        assert [(-c, r) for c, r in got] == want


def test_isotonic_never_falls():
    x, y = tx.isotonic(np.array([0.1, 0.4, 0.2, 0.9, 0.8]), np.array([0, 1.0, 1, 1, 0]), np.ones(5))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and y[0] == 0 and y[-1] == 1


def test_odd_rows(spark, make):
    docs, labels = data(spark, 200, 0)
    model = tx.fit(docs, labels)
    odd = make((1, None), (2, ""), (3, "... 12"), (None, "quobble " * 3), (5, "quobble " * 100_000), (5, "quobble " * 100_000))
    rows = tx.with_toxicity(odd, model).collect()
    assert len(rows) == 6 and {r["row"]["row"] for r in rows} == {"row"}
    by = {r["row"]["doc_id"]: r["score"] for r in rows}
    assert by[1] == by[2] == by[3] < 0.3 <= by[5] and by[None] >= 0.3


def test_no_labels_and_empty_tables(spark, make):
    none = spark.createDataFrame([(1, None), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    model = tx.fit(make((1, "a b"), (2, None)), none)
    assert [r["score"] for r in tx.with_toxicity(make((1, "a b")), model).collect()] == [0.0]
    model = tx.fit(make(), none.limit(0))
    assert tx.with_toxicity(make(), model).count() == 0
