import random

import numpy as np
from pyspark.sql import functions as F

from shelfmark.llm import langid

SYLLABLES = {"aa": "ka ro mi tu ne".split(), "bb": "schl pfe ung ich ei".split()}


def text(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")


def test_learns_and_leaves_out_held_rows(spark):
    rng = random.Random(3)
    rows = [(i, text(l := ("aa", "bb")[i % 2], rng, 80), l, "x") for i in range(300)]
    # Held-out rows carry wrong labels; learning from them would show.
    rows += [(1000 + i, text("aa", rng, 80), "bb", "x") for i in range(300)]
    docs = documents(spark, rows)
    net = langid.fit(docs, learn=F.col("doc_id") < 1000)
    got = {r["row"]["doc_id"]: r for r in langid.with_language(docs, net).collect()}
    assert np.mean([got[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in range(300)]) > 0.97
    assert np.mean([got[1000 + i]["lang_pred"] == "aa" for i in range(300)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_tables_give_the_network(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(32, 128, (90, langid.WINDOW)).astype(np.uint8)
    net = langid.train(x, np.arange(90) % 3, ["a", "b", "c"], epochs=1)
    net.prepare()
    hidden, _ = net.pooled(x)
    assert np.allclose(net.probabilities(x), langid.softmax(hidden @ net.weights + net.offset), atol=1e-4)


def test_odd_texts(spark):
    rng = random.Random(5)
    train = [(i, text("aa" if i % 2 else "bb", rng, 40), "aa" if i % 2 else "bb", None) for i in range(60)]
    net = langid.fit(documents(spark, train))
    odd = [(1, None, None, None), (2, "", "aa", None), (3, "123 !? 45", "bb", None), (None, "karo", None, None), (4, "ka " * 60000, "aa", None), (4, "ka " * 60000, "aa", None)]
    got = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in langid.with_language(documents(spark, odd), net).collect()]
    assert sorted(got[:3]) == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3][1] in ("aa", "bb") and got[4] == got[5] and got[4][1] == "aa"


def test_nothing_to_learn(spark):
    docs = documents(spark, [(1, "words", None, None)])
    assert langid.fit(docs) is None
    assert langid.with_language(docs, None).first()["lang_pred"] == "und"
    empty = documents(spark, [])
    assert langid.fit(empty) is None and langid.with_language(empty, None).count() == 0


def test_sample_is_bounded(spark):
    rng = random.Random(9)
    rows = [(i, text("aa", rng, 30), "aa" if i % 50 else "bb", None) for i in range(500)]
    x, y, languages = langid.training_windows(documents(spark, rows), "text", "lang", "doc_id", F.lit(True), 40, 45)
    assert languages == ["aa", "bb"] and len(x) <= 45 * langid.WINDOWS_PER_TEXT and 0 < y.sum() < len(y)
