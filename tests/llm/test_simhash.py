import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import common, simhash


def brute_print(text, n=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, max_bits):
    """Least member of each component of all links; prints are unsigned."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_fingerprints():
    texts = [None, "", "  ", "One", "one two", "One TWO three", "one two three\tfour\nfour four", "É é x " * 50, "a " * 40000]
    for t in texts:
        got = simhash.fingerprint(None if t is None else t.encode(), 3)
        assert got % (1 << 64) == brute_print(t)


def near_prints(rng, n):
    out = []
    for _ in range(n):
        if out and rng.random() < 0.7:
            x = rng.choice(out)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
        else:
            x = rng.getrandbits(64)
        out.append(x)
    return out


def linked(spark, prints, max_bits, chunk, agreeing=None):
    df = spark.createDataFrame([(simhash.signed(p),) for p in set(prints)], "fp bigint")
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, max_bits, chunk=chunk, agreeing=agreeing).collect()]
    assert all((a ^ b).bit_count() <= 64 and a != b for a, b in pairs)
    return pairs


def test_links_give_all_components(spark):
    rng = random.Random(11)
    for chunk, agreeing in ((4096, None), (5, None), (4096, 4)):
        # Many prints within a few bits of each other fill buckets beyond the chunk.
        prints = sorted(set(near_prints(rng, 400)))
        pairs = linked(spark, prints, 3, chunk, agreeing)
        place = {p: i for i, p in enumerate(prints)}
        label = list(range(len(prints)))

        def root(i):
            while label[i] != i:
                i = label[i]
            return i

        for a, b in pairs:
            x, y = root(place[a]), root(place[b])
            label[max(x, y)] = min(x, y)
        assert [root(i) for i in range(len(prints))] == brute_classes(prints, 3)


def test_blocks_follow_the_number_of_fingerprints():
    assert [simhash.agreeing_blocks(n, 3) for n in (0, 10**5, 10**8, 3 * 10**10)] == [2, 2, 3, 4]


def test_forest_is_small():
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = np.array(sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)}), np.uint64)
    tables = np.array([[(int(p) ^ q).bit_count() for p in prints] for q in simhash.pivots(8)], np.int8)
    a, b = simhash.forest(prints, tables, 3)
    assert len(a) == len(prints) - 1


def test_near_duplicates(make):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    long = [" ".join(rng.choices(words, k=400)) for _ in range(20)]
    texts = long + long[:5] + [long[6].upper(), long[7] + " tail"] + [None, "", "a", "a"]
    rows = simhash.near_duplicates(make(*enumerate(texts))).collect()
    prints = [brute_print(t) for t in texts]
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in rows} == dict(enumerate(prints))
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(brute_classes(prints, 3)))


def test_null_and_repeated_ids(make):
    rows = simhash.near_duplicates(make((None, "x y z"), (7, "x y z"), (7, "x y z"), (None, "other"), (3, None), (9, ""))).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in rows), key=str)
    assert got == sorted([(None, 7), (7, 7), (7, 7), (None, None), (3, 3), (9, 3)], key=str)
    assert simhash.near_duplicates(make()).count() == 0


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, i) for i in range(1001, 1400)] + [(1000, 1000)]
    rows = common.components(spark.createDataFrame(chain + hub + chain, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in rows} == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1400), 1000)}
    assert len(rows) == 61 + 400
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_first_of_each(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    rows = common.first_of_each(df, ["k"], ["o"], 3).collect()
    assert sorted((r["k"], r["o"], r["r"]) for r in rows) == [(k, k + 2 * i, i + 1) for k in (0, 1) for i in range(3)]
