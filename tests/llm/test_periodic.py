import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import periodic
from shelfmark.llm.queries import QUERIES


def brute(text, least=24, periods=3):
    """(n_words, runs, strongest, collapsed), from every lag and every stretch of matches."""
    w = (text or "").encode().split()
    n, runs = len(w), []
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            lo = i
            while i < n and w[i] == w[i - q]:
                i += 1
            start, length = lo - q, i - lo + q
            part = w[start : start + length]
            smaller = any(part[d:] == part[:-d] for d in range(1, q))
            if length >= max(least, periods * q) and not smaller:
                runs.append((start, length, q))
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {k for s, n_, q in runs for k in range(s + q, s + n_)}
    best = min(range(len(runs)), key=lambda k: (-runs[k][1] / runs[k][2], k), default=None)
    return n, runs, best, b" ".join(x for k, x in enumerate(w) if k not in gone).decode()


def found(make, texts, **options):
    rows = periodic.with_runs(make(*enumerate(texts)), **options).orderBy("row.doc_id").collect()
    return [(r["n_words"], [tuple(x) for x in r["runs"]], r["strongest"], r["collapsed"]) for r in rows]


def repeats(rng, letters):
    words = []
    for _ in range(rng.randint(1, 6)):
        unit = rng.choices(letters, k=rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 12, 16, 17, 20, 33]))
        if rng.random() < 0.3:
            unit = unit * 3 + rng.choices(letters, k=1)
        many = unit * rng.randint(1, 9)
        words += many[: rng.randint(1, len(many))]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = rng.choice(letters)
    return " ".join(words)


@pytest.mark.parametrize("letters", ["ab", "abcdefghij"])
@pytest.mark.parametrize("options", [{}, {"least": 6}, {"least": 40, "periods": 5}], ids=str)
def test_against_brute_force(make, letters, options):
    rng = random.Random(len(letters) + len(options))
    texts = [repeats(rng, letters) for _ in range(60)]
    want = [brute(t, **options) for t in texts]
    assert any(w[1] for w in want) and found(make, texts, **options) == want


def test_block_sizes():
    assert periodic.first_block(24, 3) == 16
    for least, periods in ((1, 3), (6, 3), (24, 3), (40, 5), (100, 3)):
        size = periodic.first_block(least, periods)
        assert all(max(least - q, (periods - 1) * q) >= size for q in range(1, 300))


def test_edges(make):
    texts = [None, "", " \t\n", "a " * 23, "a " * 24, "a b " * 11 + "a", "a b " * 12, "x " + "a b c " * 9 + "a y",
             " ".join(f"w{i % 30}" for i in range(89)), " ".join(f"w{i % 30}" for i in range(90)),
             "é é " * 30, "a\x0bb\x0c" * 40]
    got = found(make, texts)
    assert got == [brute(t) for t in texts]
    assert got[0] == (0, [], None, "") and got[3][1] == [] and got[4][1] == [(0, 24, 1)]
    assert got[8][1] == [] and got[9][1] == [(0, 90, 30)]
    assert periodic.with_runs(make()).count() == 0
    with pytest.raises(ValueError):
        periodic.with_runs(make(), periods=2)


def test_ties_of_length_per_period(make):
    one = "a " * 30
    two = "c d " * 30
    assert found(make, [one + "x " + two, two + "x " + one])[0][2] == 0
    assert [r[1][r[2]] for r in found(make, [one + "x " + two, two + "x " + one])] == [(0, 30, 1), (0, 60, 2)]


def test_long_texts_and_repeated_rows(make):
    rng = random.Random(2)
    unit = [f"u{i}" for i in range(7000)]
    texts = ["a " * 60_000, " ".join(unit * 3), " ".join(f"r{rng.random()}" for _ in range(30_000)), "a " * 60_000]
    # A line that comes back with something new each time has many occurrences and no run.
    texts.append(" ".join(f"{' '.join(unit[:25])} n{i}" for i in range(2000)))
    got = found(make, texts)
    assert [g[1] for g in got] == [[(0, 60_000, 1)], [(0, 21_000, 7000)], [], [(0, 60_000, 1)], []]
    assert got[0] == got[3] and got[0][3] == "a"


def test_clashing_names(make):
    row = periodic.with_runs(make((7, "a " * 30)).withColumnRenamed("score", "runs")).first()
    assert row["row"]["runs"] == 2.0 and row["row"]["kept"] == "fp" and len(row["runs"]) == 1


def damaged(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return b" ".join(w).decode()


def test_query_against_brute_force(spark, make, tmp_path):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randint(0, 150)))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, "a\t" * 50), (402, "a\t" * 50)]
    make(*docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    got = sorted((tuple(r) for r in rows), key=repr)
    want = []
    for i, text in docs:
        n, runs, best, collapsed = brute(damaged(i, text))
        s, length, q = runs[best] if runs else (None, None, None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed)]
        want.append((i, len(runs), s, length, q, length and 1000 * length // q, *sha))
    assert got == sorted(want, key=repr) and sum(r[1] > 0 for r in got) > 15


def test_damage_is_a_column(spark):
    from shelfmark.llm.queries import with_periodic_tails

    rng = random.Random(9)
    docs = [(i, " ".join(str(rng.randrange(50)) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"].split() for r in df.select("doc_id", with_periodic_tails(F.col("text")).alias("text")).collect()}
    assert got == {i: damaged(i, t).split() for i, t in docs}
