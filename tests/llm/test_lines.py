import random

import pytest

from shelfmark.llm import lines as ln


def brute(docs, min_lines, long_line):
    """Kept text and deleted line places per document; ids are different."""
    order = sorted((i, t) for i, t in docs if t is not None)
    seqs = {i: [(p, x) for p, x in enumerate(t.split("\n")) if x.strip(ln.BLANK)] for i, t in order}
    first = {}
    for size in {1, min_lines}:
        for i, _ in order:
            s = seqs[i]
            for k in range(len(s) - size + 1):
                first.setdefault((size, tuple(x for _, x in s[k : k + size])), (i, k))
    out = {}
    for i, t in order:
        s, gone = seqs[i], set()
        for size in {1, min_lines}:
            for k in range(len(s) - size + 1):
                if size < min_lines and len(s[k][1]) < long_line:
                    continue
                j, at = first[size, tuple(x for _, x in s[k : k + size])]
                if j != i or at + size <= k:
                    gone.update(range(s[k][0], s[k + size - 1][0] + 1))
        rows = t.split("\n")
        out[i] = ("\n".join(x for p, x in enumerate(rows) if p not in gone), len(s), len({p for p, _ in s} & gone), sorted(gone))
    return out


def check(make, docs, min_lines=2, long_line=40):
    rows = ln.without_repeated_lines(make(*docs), min_lines, long_line).collect()
    assert len(rows) == len(docs)
    want = brute(docs, min_lines, long_line)
    for r in rows:
        if r["row"]["text"] is not None:
            got = (r["kept"], r["n_lines"], r["n_removed"], [p for x in r["runs"] for p in range(x["lo"], x["hi"] + 1)])
            assert got == want[r["row"]["doc_id"]]
            assert r["row"]["kept"] == "fp"
    return {r["row"]["doc_id"]: r for r in rows}


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4])
def test_against_brute_force(make, min_lines):
    rng = random.Random(min_lines)
    pool = [rng.choice(["x", "yy", "", "  ", "a long line " * 4]) + str(rng.randint(0, 6)) * rng.randint(0, 2) for _ in range(25)]
    docs = []
    for i in range(80):
        own = [rng.choice(pool) if rng.random() < 0.7 else f"only {i} {k}" for k in range(rng.randint(0, 25))]
        if docs and rng.random() < 0.4:
            other = rng.choice(docs)[1].split("\n")
            lo = rng.randrange(len(other))
            own[2:2] = other[lo : lo + rng.randint(1, 20)]
        docs.append((i, "\n".join(own)))
    rng.shuffle(docs)
    check(make, docs, min_lines, 30)


def test_runs_tell_their_source(make):
    body = "\n".join(f"line {i}" for i in range(30))
    got = check(make, [(1, "head\n" + body), (2, body + "\ntail"), (3, "x\ny\n" + body)])
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 29, 1, 1)] and got[2]["kept"] == "tail"
    assert [tuple(x) for x in got[3]["runs"]] == [(2, 31, 1, 1)] and got[1]["runs"] == []


def test_periods_keep_a_first_copy(make):
    got = check(make, [(1, "a\na\na\na\na"), (2, "a\nb\na\nb\na\nb"), (3, "c\n\n\nc\n \nc")])
    assert got[1]["kept"] == "a\na" and got[2]["kept"] == "a\nb"


def test_nulls_repeated_rows_and_long_texts(make):
    long = "\n".join(f"l{i}" for i in range(20000))
    docs = [(1, long), (2, long), (3, None), (4, ""), (None, "l1\nl2"), (2, long)]
    rows = ln.without_repeated_lines(make(*docs)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["row"]["doc_id"], []).append(r)
    assert by[1][0]["n_removed"] == 0 and [r["kept"] for r in by[2]] == ["", ""]
    assert by[3][0]["kept"] is None and by[4][0]["kept"] == "" and by[None][0]["kept"] == ""
    assert [tuple(x) for x in by[None][0]["runs"]] == [(0, 1, 1, 1)]
    assert ln.without_repeated_lines(make()).count() == 0
