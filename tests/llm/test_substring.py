import random

import numpy as np
import pytest

from shelfmark.llm import substring as sub


def brute(docs, width):
    """(n_words, n_removed, kept) per row, by comparing all windows."""
    words = [(sub.NO_ID if i is None else i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] < i:
                gone.update(range(s, s + width))
        out.append((len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return out


def check(make, docs, width=13, **options):
    rows = sub.without_repeats(make(*docs), width, **options).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows)
    want = sorted((-1 if i is None else i, *b) for (i, _), b in zip(docs, brute(docs, width)))
    assert got == want


def pieces(rng, letters, n):
    """Documents that share passages of all lengths around the window's."""
    pool = [rng.choices(letters, k=rng.randint(3, 60)) for _ in range(25)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(pool)
            lo = rng.randrange(len(p))
            words += p[lo : lo + rng.randint(1, 40)] if rng.random() < 0.7 else rng.choices(letters, k=rng.randint(1, 20))
        docs.append((i, " ".join(words)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("letters", [["a", "b"], [f"w{i}" for i in range(300)]], ids=["two words", "many words"])
@pytest.mark.parametrize("slice_words", [1 << 20, 50])
def test_against_brute_force(make, monkeypatch, letters, slice_words):
    monkeypatch.setattr(sub, "SLICE_WORDS", slice_words)
    rng = random.Random(len(letters) + slice_words)
    check(make, pieces(rng, letters, 120), n_buckets=7)


def test_runs_periods_and_edges(make):
    alike = " ".join(f"x{i}" for i in range(40))
    docs = [
        (1, "a " * 100),
        (2, "a " * 12),
        (3, "a " * 13),
        (4, "b " + "a " * 20 + "c"),
        (5, "a b " * 50),
        (6, "b a " * 7),
        (7, alike),
        (8, "pre " + alike[:60] + " post"),
        (9, " \t".join(alike.split()[13:26])),
        (10, "\n".join(alike.split()[14:26])),
        (11, "é é " * 20),
        (12, "é é " * 20),
    ]
    check(make, docs)


def test_nulls_ties_and_repeated_rows(make):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(None, passage), (5, passage), (5, passage), (5, "q " + passage), (2, None), (3, ""), (None, passage + " end"), (8, passage)]
    check(make, docs)
    check(make, [(None, passage), (None, passage)])
    assert sub.without_repeats(make()).count() == 0


def test_very_long_and_many_copies(make):
    rng = random.Random(4)
    long = " ".join(rng.choices([f"w{i}" for i in range(2000)], k=30000))
    docs = [(0, long), (1, long), *((i, "w1 w2 " * 10 + str(i)) for i in range(2, 400))]
    check(make, docs)


def test_cuts_depend_on_their_surroundings_only():
    rng = np.random.default_rng(6)
    for size in (2, 5, 1000):
        names = sub.mixed(rng.integers(0, size, 3000).astype(np.uint64) + np.uint64(9))
        whole = set(sub.recompressed(names, np.arange(len(names)) == 0).tolist())
        assert max(np.diff(sorted(whole))) <= sub.LONGEST
        for _ in range(200):
            lo = int(rng.integers(0, 2900))
            part = names[lo : lo + 30]
            cuts = {lo + int(c) for c in sub.recompressed(part, np.arange(len(part)) == 0)}
            inner = range(lo + sub.REACH, lo + 30 - sub.REACH + 1)
            assert {c for c in inner if c in cuts} == {c for c in inner if c in whole}
            for start in range(lo, lo + 30 - sub.WIDTH + 1):
                assert any(c in cuts for c in range(start + sub.REACH, start + sub.WIDTH - sub.REACH + 1))


def test_narrow_windows_are_refused(make):
    with pytest.raises(ValueError):
        sub.without_repeats(make((1, "a")), width=10)
