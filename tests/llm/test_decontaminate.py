import pickle
import random

import numpy as np
import pytest

from shelfmark.llm import decontaminate as dc

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven"),
    (2, "short item"),
    (3, "..."),
    (4, None),
    (5, "One two three four five six seven eight nine ten eleven"),
    (None, "zeta eta theta"),
    (6, "a a a a a a a a a a a a"),
    (7, "ñandú ÉTÉ x9"),
]


def brute(text, items, width):
    words = dc.words_of(None if text is None else text.encode())
    hit, found = set(), set()
    for item, body in items:
        own = dc.words_of(None if body is None else body.encode())
        for at in range(max(1, len(own) - width + 1) if own else 0):
            w = own[at : at + width]
            for p in range(len(words) - len(w) + 1):
                if words[p : p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(item)
    return len(words), len(hit), sorted(found - {None})


def check(spark, make, texts, items, **options):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = dc.with_hits(make(*enumerate(texts)), table, **options).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["row"]["doc_id"]], items, options.get("width", 10))
        assert (r["n_words"], r["n_hit"], r["items"]) == want, texts[r["row"]["doc_id"]]
        assert r["row"]["kept"] == "fp"


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 40])
def test_against_brute_force(spark, make, block_bytes):
    texts = [
        None,
        "",
        "?!",
        "x one TWO three-four five six seven eight nine ten eleven, y",
        "two three four five six seven eight nine ten elevens",
        "a Short, item here; short item",
        "zeta eta theta",
        "a " * 30,
        "Ñandú ñandú ÉTÉ x9 ñandú été x9",
        "one two three four five six seven eight nine ten " * 3,
        "one two three four five six seven eight nine ten",
        "one two three four five six seven eight nine ten",
    ]
    check(spark, make, texts, ITEMS, block_bytes=block_bytes)


def test_random_words(spark, make):
    rng = random.Random(8)
    letters = "abcd"
    items = [(i, " ".join(rng.choices(letters, k=rng.randint(1, 9)))) for i in range(30)]
    texts = [" ".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(60)]
    check(spark, make, texts, items, width=5, block_bytes=60)


def test_long_items_and_texts_in_pieces(spark, make, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(dc, "PIECE", 7)
    monkeypatch.setattr(dc, "AT_A_TIME", 5)
    long = [f"w{rng.randint(0, 40)}" for _ in range(1500)]
    items = [(1, " ".join(long[:600])), (2, " ".join(long[300:330])), (-1, "w1 w2"), (3, " ".join(long[590:600]))]
    texts = [" ".join(long), " ".join(long[250:420] * 3), " ".join(long[595:]), "w1 w2 " * 50, " ".join(long[591:599])]
    check(spark, make, texts, items, block_bytes=400)
    check(spark, make, texts, items)


def test_index_is_a_few_arrays():
    rng = random.Random(9)
    words = [f"{rng.randint(0, 5000):x}" for _ in range(120_000)]
    index = dc.Index([(i, " ".join(words[i : i + 2000]).encode()) for i in range(0, len(words), 2000)], 10, 3)
    index.set_prefixes(np.arange(0), np.arange(0))
    size = len(pickle.dumps(index))
    assert len(index.windows) > 110_000 and size < 100 * len(words)


def test_clean_keeps_columns_and_rows(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = make((1, "short item"), (2, "clean text"), (None, None), (2, "clean text"))
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == ["", "clean text", "clean text"]


def test_empty_tables(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert dc.with_hits(make(), items).count() == 0
    row = dc.with_hits(make((1, "a b")), items.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (2, 0, [])
