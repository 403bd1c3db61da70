import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.similarity import _ratio
from shelfmark.operators import catalogue as cat
from shelfmark.sources.sinks import stored_below

BOOKS = "book_id string, title string, author string"
ENTRIES = "title string, author string, url string, no bigint"


def brute(books, entries, threshold=70.0):
    out = {}
    for book, title, author in books:
        best = None
        for t, a, url, no in sorted(entries, key=lambda e: e[3]):
            if None in (title, author, t, a):
                continue
            score = _ratio(title.lower(), t.lower()) * 0.6 + _ratio(author.lower(), a.lower()) * 0.4
            if score >= threshold and (best is None or score > best[1]):
                best = (no, score)
        out[book] = best
    return out


def changed(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("abcxyz é") + text[at:]])
    return text


def tables(rng, words, n):
    names = [" ".join(rng.choices(words, k=rng.randint(1, 4))).title() for _ in range(n)]
    people = [" ".join(rng.choices(words, k=2)).title() for _ in range(n // 4)]
    entries = [(rng.choice(names), rng.choice(people), f"/b/{i}", i) for i in range(n)]
    books = []
    for i in range(n):
        t, a, _, _ = rng.choice(entries)
        kind = rng.random()
        title = changed(rng, t, rng.choice([0, 0, 1, 2, 5])) if kind < 0.8 else rng.choice(names)
        author = changed(rng, a, rng.choice([0, 0, 1, 4])) if kind < 0.9 else rng.choice([None, "", "Nobody", rng.choice(people)])
        books.append((str(i), title, author))
    return books, [*entries, (None, "X", "/n", n), ("", "", "/e", n + 1), ("Y", None, "/m", n + 2)]


@pytest.mark.parametrize("words", [["red", "old", "ring", "bolt", "gear"], [f"{a}{b}er" for a in "klmnst" for b in "aeiou"]], ids=["few", "many"])
@pytest.mark.parametrize("threshold", [70.0, 93.0])
def test_against_all_pairs(spark, tmp_path, words, threshold):
    rng = random.Random(len(words))
    books, entries = tables(rng, words, 160)
    entries += [(t, a, f"{u}/again", 1000 + n) for t, a, u, n in entries[:50]]
    found = cat.with_best_entry(
        spark.createDataFrame(books, BOOKS), spark.createDataFrame(entries, ENTRIES), "no", threshold, stored_below(str(tmp_path))
    )
    got = {r["book_id"]: r["match"] and (r["match"]["no"], round(r["match_score"], 9)) for r in found.collect()}
    want = {b: m and (m[0], round(m[1], 9)) for b, m in brute(books, entries, threshold).items()}
    assert got == want and sum(m is not None for m in want.values()) > 40


def test_empty_tables_and_weak_thresholds(spark):
    books, entries = spark.createDataFrame([("1", "A", "B")], BOOKS), spark.createDataFrame([], ENTRIES)
    assert [tuple(r) for r in cat.with_best_entry(books, entries, "no").collect()] == [("1", "A", "B", None, None)]
    assert cat.with_best_entry(books.filter("false"), entries, "no").count() == 0
    with pytest.raises(ValueError):
        cat.with_best_entry(books, entries, "no", threshold=60.0)


def test_the_bound_on_shared_grams_loses_nothing(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(800):
        a = "".join(rng.choices("abcd", k=rng.randint(0, 14)))
        pairs.append((a, changed(rng, a, rng.randint(0, 5))))
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.select("a", "b", cat.grams(F.col("a")).alias("g"), cat.grams(F.col("b")).alias("h"))
    for r in df.withColumn("shared", F.size(F.array_intersect("g", "h"))).collect():
        ratio = _ratio(r["a"], r["b"]) / 100
        assert r["shared"] >= (len(r["a"]) + len(r["b"])) * (1.5 * ratio - 1) + 1 - 1e-9
        assert len(set(r["g"])) == len(r["g"]) == len(r["a"]) + 1


def test_no_pairs_are_made_without_a_key(spark, tmp_path):
    rng = random.Random(6)
    books, entries = tables(rng, ["red", "old", "ring"], 40)
    found = cat.with_best_entry(spark.createDataFrame(books, BOOKS), spark.createDataFrame(entries, ENTRIES), "no")
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
