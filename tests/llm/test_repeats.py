import random

import numpy as np
import pytest

from shelfmark.llm import repeats as rep


def brute(docs, width=100):
    """(n_bytes, n_removed, spans, kept) per row, by comparing all windows."""
    texts = [(rep.NO_ID if i is None else i, (t or "").encode()) for i, t in docs]
    first, own = {}, {}
    for i, t in texts:
        for s in range(len(t) - width + 1):
            w = t[s : s + width]
            first[w] = min(first.get(w, i), i)
            own[i, t, w] = min(own.get((i, t, w), s), s)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            w = t[s : s + width]
            if first[w] < i or own[i, t, w] < s:
                gone[s : s + width] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]
        out.append((len(t), int(gone.sum()), spans, bytes(x for x, g in zip(t, gone) if not g)))
    return out


def check(make, docs, width=100, **options):
    rows = rep.without_repeats(make(*docs), width, **options).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows]
    assert sorted(got, key=repr) == sorted(((i, *b) for (i, _), b in zip(docs, brute(docs, width))), key=repr)


def pieces(rng, letters, n):
    """Documents that share passages of all lengths around the window's, some with small changes."""
    pool = ["".join(rng.choices(letters, k=rng.randint(60, 700))) for _ in range(12)]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(pool)
            lo = rng.randrange(len(p))
            part = p[lo : lo + rng.randint(50, 400)]
            if part and rng.random() < 0.3:
                at = rng.randrange(len(part))
                part = part[:at] + rng.choice(letters) + part[at + 1 :]
            text += part if rng.random() < 0.8 else "".join(rng.choices(letters, k=rng.randint(1, 120)))
        docs.append((i, text))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyzéß "], ids=["two", "many"])
@pytest.mark.parametrize("small", [False, True], ids=["as is", "small parts"])
def test_against_brute_force(make, monkeypatch, letters, small):
    """With small parts: many slices, blocks and sorts, and names whose windows are dealt one by one."""
    if small:
        for name, value in (("SLICE_BYTES", 3000), ("BLOCK", 256), ("SORTED", 50), ("MOST_STRETCHES", 3)):
            monkeypatch.setattr(rep, name, value)
        rep.powers.cache_clear()
    rng = random.Random(len(letters) + small)
    check(make, pieces(rng, letters, 90), n_buckets=5)
    rep.powers.cache_clear()


def test_runs_and_edges(make):
    rng = random.Random(1)
    alike = "".join(rng.choices("abcdefgh ", k=400))
    docs = [
        (1, "a" * 500), (2, "a" * 99), (3, "a" * 100), (4, "b" + "a" * 130 + "c"), (5, "ab" * 200), (6, alike), (7, "x" + alike[:250] + "y"),
        (8, alike[100:200]), (9, alike[100:199]), (10, alike[50:150] + "z" + alike[50:150]), (11, "é" * 120), (12, "\x00" * 150),
        (13, alike[:150] + "\x00" + alike[:150] + "\x00\x00" + alike[:150]), (14, "x" + alike[300:] + alike[:120]),
    ]
    check(make, docs)
    check(make, docs[::-1], width=48, n_buckets=1)


def test_nulls_ties_and_repeated_rows(make):
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=250))
    docs = [(None, passage), (5, passage), (5, passage), (5, "q" + passage), (2, None), (3, ""), (None, passage + " end"), (8, passage)]
    check(make, docs)
    check(make, [(None, passage), (None, passage), (None, passage[:200])])
    check(make, [(5, passage + passage[:150]), (5, passage + passage[:150])])
    assert rep.without_repeats(make()).count() == 0


def test_very_long_and_many_copies(make):
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefgh \n", k=300_000))
    common = "".join(rng.choices("abcdefgh ", k=130))
    docs = [(0, long), (1, long), *((i, f"{rng.random()}{common}{rng.random()}") for i in range(2, 300))]
    check(make, docs)


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(5)
    a, b = ("".join(rng.choices("xyz", k=k)).encode() for k in (120, 150))
    stretches = [b"1" + a + b"2", b"3" + a + b"2", b"4" + a + b"5", b"6" + b, b"6" + b, b"7" + a[:110] + b"8"]
    data = b"".join(stretches)
    sizes = np.array([len(s) for s in stretches])
    found = {}
    for depth, at in rep.maximal_repeats(data, sizes, sizes - 99, 100):
        found[data[at[0] : at[0] + depth]] = sorted(at.tolist())
    at = [m for m in range(len(data)) if data.startswith(a[:110], m)]
    assert found == {
        a[:110]: at,
        a: [m for m in at if data.startswith(a, m)],
        a + b"2": [m for m in at if data.startswith(a + b"2", m)],
        b"6" + b: [m for m in range(len(data)) if data.startswith(b"6" + b, m)],
    }


def test_intervals():
    assert sorted(rep.intervals(np.array([0, 5, 7, 7, 5, 0, 6]), 5)) == [(5, 0, 4), (6, 5, 6), (7, 1, 3)]
    assert list(rep.intervals(np.array([0, 4, 3]), 5)) == []


def test_widths_are_checked(make):
    for width in (40, 2000):
        with pytest.raises(ValueError):
            rep.without_repeats(make((1, "a")), width=width)
