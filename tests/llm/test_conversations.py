import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from shelfmark.llm import conversations as conv
from shelfmark.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, row string, audit int"
P = conv.Prices()


def table(spark, rows):
    return spark.createDataFrame([(*r, "row", 1) for r in rows], SCHEMA)


def brute(rows, p=P):
    """Everything about one conversation; edits by trying all of them, from the last row to the first."""
    plain = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    plain.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = []
    for i, (_, role, text) in enumerate(plain):
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        seen = any(q[1:] == (role, text) for q in plain[:i])
        faults.append("blank" if not body else "duplicate" if seen else "truncated" if body[-1] not in ".!?" else "fine")

    @cache
    def best(i, roles, inserted):
        """(cost, audit) of the rest, after ``roles`` (its last two initials tell enough)."""
        options = []
        if i == len(plain) and (not roles or roles[-1] == "a"):
            options.append((0, ""))
        follow = "u" if not roles or roles[-1] in "sa" else "a"
        if i < len(plain):
            initial, fault = plain[i][1][:1], faults[i]
            cost, audit = best(i + 1, roles, 0)
            options.append((cost + p.delete, "D" + audit))
            if fault in ("fine", "truncated"):
                more = p.truncated if fault == "truncated" else 0
                if initial == follow or (initial == "s" and not roles):
                    cost, audit = best(i + 1, initial, 0)
                    options.append((cost + more, "K" + audit))
                cost, audit = best(i + 1, follow, 0)
                options.append((cost + more + p.rerole, "R" + audit))
        if inserted < 3:
            cost, audit = best(i, follow, inserted + 1)
            options.append((cost + p.insert, "I" + audit))
        return min(options, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    lines, i, last = [], 0, ""
    for e in audit:
        role, text = plain[i][1:] if e != "I" else ("", "")
        i += e != "I"
        if e == "D":
            continue
        follow = "user" if last in ("", "s", "a") else "assistant"
        role = role if e == "K" else follow
        last = role[0]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    turns = [t for t, _, _ in plain if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in plain]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha)


def told(df):
    out = {}
    for r in df.collect():
        gaps = 0 if r["low"] is None else r["high"] - r["low"] + 1 - r["turns"]
        out[r["conv_id"]] = (gaps, *[r[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])
    return out


def check(spark, rows, prices=P):
    by_conv = {}
    for c, *rest in rows:
        by_conv.setdefault(c, []).append(tuple(rest))
    got = told(conv.repaired(table(spark, rows), prices))
    assert got == {c: brute(r, prices) for c, r in by_conv.items()}


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ua"]
TEXTS = ["Yes.", "No!", "cut", " ", "", None, "Well?  \n", "x.y", "é", "Why?"]


def talk(rng, c, n, turns):
    return [(c, rng.choice([None, *range(turns)]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]


@pytest.mark.parametrize("prices", [P, conv.Prices(2, 9, 1, 1), conv.Prices(1, 1, 1, 1)], ids=str)
def test_against_brute_force(spark, prices):
    rng = random.Random(sum(prices))
    rows = [r for c in range(250) for r in talk(rng, c, rng.randint(1, 9), 6)]
    rows += [r for c in range(250, 320) for r in talk(rng, c, rng.randint(10, 40), 60)]
    rng.shuffle(rows)
    check(spark, rows, prices)


@pytest.fixture
def many_tasks(spark):
    """Small partitions are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("prices", [P, conv.Prices(1, 3, 1, 2)], ids=str)
def test_a_conversation_in_many_tasks(spark, many_tasks, prices):
    rng = random.Random(3)
    rows = [r for c in (1, 2) for r in talk(rng, c, 300, 100)]
    rows += [(3, t, rng.choice(["user", "assistant"]), f"t{t}{rng.choice('.?,')}") for t in range(600)]
    rows += [(None, t, ROLES[t % 3], "Same.") for t in range(40)] + [(9, 1, "user", "a.")]
    df = table(spark, rows)
    lots = conv.in_order(conv.faults(df)).select("conv_id", "part").distinct().groupBy("conv_id").count().filter("count > 1")
    assert lots.count() >= 2
    check(spark, rows, prices)


def test_long_conversations_go_out_in_pieces(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(conv, "PIECE", 200)
    rng = random.Random(4)
    check(spark, [(1, t, rng.choice(["user", "assistant"]), f"Line {t} of it{rng.choice('.!,')}") for t in range(400)])


def test_nulls_ties_copies_and_empty_tables(spark):
    check(spark, [(None, None, None, None), (None, 2, "user", "a."), (5, None, "user", "a."), (5, None, "user", "a."), (5, 0, "user", "a.")])
    check(spark, [(1, 1, "user", "a.")] * 30 + [(1, 2, "assistant", "b.")] * 2)
    check(spark, [(1, 1, "", "a."), (1, 1, "user", ""), (2, 7, "system", "s.")])
    assert conv.repaired(table(spark, [])).count() == 0


def test_settled_edits_leave_memory():
    out, most = [], 0
    search = conv.Search(conv.START, P, out.append)
    rng = random.Random(1)
    for t in range(5000):
        search.step("ua"[t % 2] if rng.random() < 0.9 else rng.choice("uas"), rng.choice([conv.FINE] * 9 + [conv.TRUNCATED]), 0, ("x", str(t)))
        most = max(most, t + 1 - len(out))
    assert most < 100
    search.end(conv.last_state(search))
    assert len([e for e in out if e[0] != "I"]) == 5000


def test_query_takes_conversations_that_vanish(spark, tmp_path):
    """The damage drops some conversations whole; they are told of with zeros."""
    rows = [(c, t, r, x) for c in range(300) for t, (r, x) in enumerate([("user", "Hi there."), ("assistant", "Yes. No")][: 1 + c % 2])]
    rows += [(None, 1, "user", None), (None, None, None, "x.")]
    table(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(got) == 301
    empty = hashlib.sha256(b"").hexdigest()
    gone = [r for r in got if r["audit"] == ""]
    assert gone and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in gone)


def damaged(rows):
    """The damage that the query does, row by row."""
    out = {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out.setdefault(c, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def test_sql_against_brute_force():
    """Also where the damage repeats a row, so that equal rows have one turn."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(12)
    rows = [(c, t, rng.choice(ROLES[:5]), rng.choice(TEXTS) if rng.random() < 0.3 else f"{c} {t}.") for c in range(250) for t in range(rng.randint(1, 6))]
    rows += [(None, t, "user", None) for t in range(3)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    told_by_sql = {r[0]: r[1:] for r in con.execute(f"SELECT {names} FROM ({ORACLE['op11_conversation_repair']})").fetchall()}
    assert told_by_sql == {c: brute(r) for c, r in damaged(rows).items()}
    assert sum("KD" in r[6] for r in told_by_sql.values()) > 5
