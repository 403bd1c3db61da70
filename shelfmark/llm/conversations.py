"""Repair of conversation structure, by a Viterbi search whose survivors coalesce.

A repaired conversation has the roles system (at most once, first), then user and assistant in turn,
user first and assistant last; or it is empty. Edits keep, rerole, delete or insert a row, each at a
price. The search goes over a conversation's rows with one survivor for each state: the cheapest
edits so far that end in it. Survivors are leaves of a tree of backpointers whose nodes count their
references. A survivor that is given up, for a better one in its state or since another state is so
much cheaper that it cannot win any more, releases its branch; as soon as all survivors descend from
one child of the root, that child's edit can no longer change and is emitted. So only the part on
which survivors disagree is held. Of survivors that cost the same the one whose edits spell the lesser
string stays. Their complete unresolved suffixes decide that; no suffix is a prefix of another, since
each ends with an edit of the same row, so the order among survivors follows from the order of their
parents and one pair of edits, and is kept up to date as a rank.

Rows are sorted over all tasks by ranges of conversation and turn, so a conversation with a third of
all rows lies in many tasks. Such a part cannot know its first state: it is searched from each of the
four states, and tells cost and order for each pair of first and last state. These tables, at most two
per task, are put together in order and give each part its first and last state. Then all parts are
searched at the same time.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import T_to_arrow, checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Prices(NamedTuple):
    """What edits cost; a truncated row that is not deleted costs ``truncated`` besides."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


# States: nothing yet, system, user and assistant came last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# The state after each state once a user or an assistant follows.
FOLLOWING = {"u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "s": {START: SYSTEM}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
# At the end of a conversation, this many insertions lead from a state to one that may be the last.
CLOSING = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
LEGAL = ("su", "ua", "au")
# Faults of a row.
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
# Characters of repaired text and edits that are handed on together.
PIECE = 1 << 20

PARTS = "conv_id {id}, part int, start int, ends array<struct<state:int,cost:bigint,order:int>>"
PIECES = (
    "conv_id {id}, part int, piece bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, low bigint, high bigint, turns bigint, first_initial string, last_initial string, first_turn bigint, "
    "last_turn bigint, audit string, lines bigint, repaired binary, sha string"
)


class Node:
    """An edit in the tree of backpointers; ``refs`` counts children and survivors."""

    __slots__ = ("children", "edit", "parent", "refs")

    def __init__(self, parent: Node | None, edit: tuple | None):
        self.parent, self.edit, self.refs, self.children = parent, edit, 0, []
        if parent is not None:
            parent.refs += 1
            parent.children.append(self)

    def release(self) -> None:
        """Give up a reference; branches without any are cut."""
        node = self
        node.refs -= 1
        while not node.refs and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            parent.refs -= 1
            node.parent = None
            node = parent


class Survivor(NamedTuple):
    cost: int
    order: int
    node: Node | None


def insertions(state: int, prices: Prices) -> Iterator[tuple[int, int, list[int]]]:
    """States that up to two inserted rows lead to, with their cost and the states on the way."""
    yield state, 0, []
    way, at = [], state
    for _ in range(2):
        at = ASSISTANT if at == USER else USER
        way = [*way, at]
        yield at, prices.insert * len(way), way


def detours(p: Prices) -> dict[int, dict[int, int]]:
    """What it costs at most, by state given up and state kept, to follow from the one kept any edits
    that go on from the one given up: missing rows are inserted, a system row is deleted, not kept."""
    return {
        START: {ASSISTANT: p.delete, USER: p.insert + p.delete, SYSTEM: 2 * p.insert + p.delete},
        SYSTEM: {START: 0, ASSISTANT: 0, USER: p.insert},
        USER: {START: p.insert, SYSTEM: p.insert, ASSISTANT: p.insert},
        ASSISTANT: {START: 0, SYSTEM: 2 * p.insert, USER: p.insert},
    }


class Search:
    """One pass over the rows of a conversation, or over a part of it from a given state.

    ``emit`` gets each edit once it is settled: (kind, state, row, copies). Without it no tree is kept,
    and only costs and order are followed.
    """

    def __init__(self, start: int, prices: Prices, emit: Callable[[tuple], None] | None = None):
        self.prices, self.emit, self.detours = prices, emit, detours(prices)
        self.root = Node(None, None) if emit else None
        self.survivors = {start: Survivor(0, 0, self.root)}
        if emit:
            self.root.refs += 1

    def step(self, initial: str, fault: int, again: int, row: tuple | None = None) -> None:
        """A row, and how many copies of it follow at once; copies are always deleted."""
        p = self.prices
        best: dict[int, tuple] = {}
        for state, (cost, order, node) in self.survivors.items():
            for at, price, way in insertions(state, p):
                options = [(at, p.delete, "D")]
                if fault < DUPLICATE:
                    more = p.truncated if fault == TRUNCATED else 0
                    after = FOLLOWING.get(initial, {}).get(at)
                    if after is not None:
                        options.append((after, more, "K"))
                    for role in "ua":
                        after = FOLLOWING[role].get(at)
                        if after is not None:
                            options.append((after, p.rerole + more, "R"))
                for after, paid, kind in options:
                    spelled = "I" * len(way) + kind
                    key = (cost + price + paid, order, spelled)
                    if after not in best or key < best[after][0]:
                        best[after] = (key, node, way, kind)
        # Survivors that cannot win any more, not even a tie, would keep the others from coalescing.
        cost = {s: b[0][0] for s, b in best.items()}
        best = {s: b for s, b in best.items() if all(cost[t] + d >= cost[s] for t, d in self.detours[s].items() if t in cost)}
        ranks = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][0][1:]))}
        before, self.survivors = self.survivors, {}
        for state, ((cost, _, _), node, way, kind) in best.items():
            if self.emit:
                for s in way:
                    node = Node(node, ("I", s, None, 1))
                node = Node(node, (kind, state, row, 1))
                if again:
                    node = Node(node, ("D", state, row, again))
                node.refs += 1
            self.survivors[state] = Survivor(cost + again * p.delete, ranks[state], node)
        if self.emit:
            for survivor in before.values():
                survivor.node.release()
            self.settle()

    def settle(self) -> None:
        """Emit what all survivors have in common."""
        while self.root.refs == 1 and self.root.children:
            child = self.root.children[0]
            self.emit(child.edit)
            child.parent = None
            # Its edit is out; the node stays as the common ancestor.
            self.root = child

    def end(self, state: int) -> int:
        """Settle on the survivor of ``state``; its cost."""
        if self.emit:
            for s, survivor in self.survivors.items():
                if s != state:
                    survivor.node.release()
            self.settle_all(self.survivors[state].node)
        return self.survivors[state].cost

    def settle_all(self, leaf: Node) -> None:
        path = []
        while leaf is not self.root:
            path.append(leaf)
            leaf = leaf.parent
        for node in reversed(path):
            self.emit(node.edit)

    def close(self, state: int) -> None:
        """Rows to insert after the last one."""
        for _ in range(CLOSING[state]):
            state = ASSISTANT if state == USER else USER
            self.emit(("I", state, None, 1))


def last_state(search: Search) -> int:
    """The state in which a whole conversation ends best, before insertions at its end."""
    insert = search.prices.insert
    return min(search.survivors, key=lambda s: (search.survivors[s].cost + CLOSING[s] * insert, search.survivors[s].order))


def put_together(parts: list[tuple[int, dict]], prices: Prices) -> list[tuple[int, int]]:
    """First and last state of each part of a conversation, from its tables: {first: {last: (cost, order)}}."""
    survivors, back = {START: (0, 0)}, []
    for _, tables in parts:
        best = {}
        for state, (cost, order) in survivors.items():
            for after, (paid, inner) in tables[state].items():
                key = (cost + paid, order, inner)
                if after not in best or key < best[after][0]:
                    best[after] = (key, state)
        ranks = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][0][1:]))}
        survivors = {s: (best[s][0][0], ranks[s]) for s in best}
        back.append({s: best[s][1] for s in best})
    state = min(survivors, key=lambda s: (survivors[s][0] + CLOSING[s] * prices.insert, survivors[s][1]))
    out = []
    for came in reversed(back):
        out.append((came[state], state))
        state = came[state]
    return out[::-1]


BLANKS = r"[^\x20\x09-\x0D]"


def faults(rows: DataFrame) -> DataFrame:
    """Different rows with the number of their copies (n) and the fault of the first copy."""
    key = ["conv_id", "turn", "role", "text"]
    each = rows.groupBy(*key).agg(F.count("*").alias("n"))
    each = each.withColumn("k1", F.xxhash64("role", "text", "conv_id")).withColumn("k2", F.xxhash64(F.lit(1), "text", "role", "conv_id"))
    # Narrow rows, aggregated before their shuffle; only what is said twice goes into the join.
    said = rows.select("turn", F.xxhash64("role", "text", "conv_id").alias("k1"), F.xxhash64(F.lit(1), "text", "role", "conv_id").alias("k2"))
    said = said.groupBy("k1", "k2").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.max(F.col("turn").isNull()).alias("unknown"))
    said = said.filter((F.col("low") < F.col("high")) | (F.col("unknown") & F.col("low").isNotNull()))
    earlier = F.col("turn").isNotNull() & (F.col("unknown") | (F.col("low") < F.col("turn")))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(BLANKS), BLANK)
        .when(F.coalesce(earlier, F.lit(False)), DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
    )
    return each.join(said, ["k1", "k2"], "left").select(*key, "n", fault.alias("fault"))


def in_order(rows: DataFrame) -> DataFrame:
    """Sorted over all tasks; ``part`` is the task. Written, so that both searches see the same parts."""
    near = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64)]
    dealt = rows.repartitionByRange(*near).sortWithinPartitions("conv_id", "turn", "role", "text")
    return checkpointed(dealt.withColumn("part", F.spark_partition_id()))


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, Iterator[tuple]]]:
    """(conversation, part, its rows) one after another."""
    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns))

    for (conv, part), group in groupby(rows(), key=lambda r: (r[0], r[6])):
        yield conv, part, group


class Digest:
    """What is told of a conversation, or of a part of it, as its rows and edits come by."""

    def __init__(self, hashed: bool):
        self.sha = hashlib.sha256() if hashed else None
        self.counts = [0, 0, 0, 0]
        self.rows = self.illegal = self.lines = self.turns = self.size = 0
        self.low = self.high = self.first_turn = self.last_turn = None
        self.first = self.before = None
        self.audit: list[str] = []
        self.text: list[bytes] = []

    def row(self, turn: int | None, role: str, fault: int, n: int) -> None:
        initial = role[:1]
        if self.first is None:
            self.first, self.first_turn = initial, turn
        elif self.before + initial not in LEGAL:
            self.illegal += 1
        # Copies stand next to each other, and no initial may follow itself.
        self.illegal += n - 1
        self.before = initial
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last_turn = turn
        self.rows += n
        self.counts[fault] += 1
        self.counts[BLANK if fault == BLANK else DUPLICATE] += n - 1

    def edit(self, edit: tuple) -> None:
        kind, state, row, copies = edit
        self.audit.append(kind * copies)
        if kind != "D":
            role = row[0] if kind == "K" else ROLES[state]
            line = f"{role}:{row[1] if row else ''}".encode()
            if self.sha:
                self.sha.update(b"\n" + line if self.lines else line)
            else:
                self.text.append(line)
                self.size += len(line)
            self.lines += 1


def repaired(rows: DataFrame, prices: Prices = Prices()) -> DataFrame:
    """Each conversation of ``rows`` (conv_id, turn, role, text) with its faults and cheapest repair.

    Returns conv_id, rows, turns (different, not null), low and high (turn), blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256. Rows are taken by turn, nulls first, then by
    role and text. A row's fault is the first of: blank, duplicate (role and text stood earlier in the
    conversation), truncated (the last character that is not white space is none of ``.!?``).
    ``illegal`` counts neighbours whose role initials are none of su, ua, au. ``audit`` spells the
    cheapest edits (Keep, Rerole, Delete, Insert), the ASCII-least of equally cheap ones, and the hash
    is of the repaired ``role:text`` lines joined by line breaks.

    Null roles and texts are one blank; an empty role has no legal initial. Rows with a null conv_id
    make up one conversation. Repeated rows are copies of a row, next to each other. A very long
    conversation is searched in parts; its hash alone has to be taken in one task, line by line. An
    empty table gives no rows. Other columns are not read.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    plain = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), blank("role"), blank("text"))
    sorted_rows = in_order(faults(plain)).select("conv_id", "turn", "role", "text", "n", "fault", "part")
    # Conversations that lie in several tasks: fewer than there are tasks.
    split = sorted_rows.groupBy("conv_id").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi")
    long = [r[0] for r in split.select("conv_id").collect()]
    states: dict[tuple[object, int], tuple[int, int, bool]] = {}
    if long:
        wanted = F.col("conv_id").isin([c for c in long if c is not None])
        wanted = F.coalesce(wanted, F.lit(None in long))

        def tables(batches):
            out = []
            for conv, part, group in conversations_of(batches):
                searches = [Search(s, prices) for s in STATES]
                for _, _, role, text, n, fault, _ in group:
                    for search in searches:
                        search.step(role[:1], fault, n - 1)
                for s, search in zip(STATES, searches):
                    ends = [{"state": e, "cost": v.cost, "order": v.order} for e, v in search.survivors.items()]
                    out.append({"conv_id": conv, "part": part, "start": s, "ends": ends})
            ends_type = pa.list_(pa.struct([("state", pa.int32()), ("cost", pa.int64()), ("order", pa.int32())]))
            if out:
                kinds = [None, pa.int32(), pa.int32(), ends_type]
                columns = [pa.array([r[c] for r in out], k) for c, k in zip(out[0], kinds)]
                yield pa.RecordBatch.from_arrays(columns, list(out[0]))

        told = sorted_rows.filter(wanted).mapInArrow(tables, PARTS.format(id=id_type)).collect()
        by_conv: dict[object, dict[int, dict]] = {}
        for r in told:
            ends = {e["state"]: (e["cost"], e["order"]) for e in r["ends"]}
            by_conv.setdefault(r["conv_id"], {}).setdefault(r["part"], {})[r["start"]] = ends
        for conv, parts in by_conv.items():
            ordered = sorted(parts.items())
            for i, ((part, _), (first, last)) in enumerate(zip(ordered, put_together(ordered, prices))):
                states[conv, part] = (first, last, i == len(ordered) - 1)

    names = [x.split()[0] for x in PIECES.split(", ")]
    id_arrow = T_to_arrow(rows.schema["conv_id"].dataType)
    arrow = [id_arrow, pa.int32(), *[pa.int64()] * 10, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]

    def search_all(batches):
        out: list[tuple] = []
        size = 0

        def ready():
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(arrow)]
            return pa.RecordBatch.from_arrays(columns, names)

        for conv, part, group in conversations_of(batches):
            given = states.get((conv, part))
            digest, piece = Digest(given is None), 0
            search = Search(given[0] if given else START, prices, digest.edit)
            for _, turn, role, text, n, fault, _ in group:
                digest.row(turn, role, fault, n)
                search.step(role[:1], fault, n - 1, (role, text))
                if given and digest.size >= PIECE:
                    # Settled lines go out; the counts follow with the last piece.
                    yield ready_piece(conv, part, piece, digest)
                    piece += 1
            last = given[1] if given else last_state(search)
            cost = search.end(last)
            if given is None or given[2]:
                search.close(last)
                cost += CLOSING[last] * prices.insert
            out.append(told_of(conv, part, piece, digest, cost, given is None))
            size += len(out[-1][16])
            if len(out) >= 1024 or size >= PIECE:
                yield ready()
                out, size = [], 0
        if out:
            yield ready()

    def ready_piece(conv, part, piece, d):
        row = (conv, part, piece, *[0] * 6, None, None, 0, None, None, None, None, "".join(d.audit), len(d.text), b"\n".join(d.text), None)
        d.audit, d.text, d.size = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, arrow)], names)

    def told_of(conv, part, piece, d, cost, whole):
        return (
            conv, part, piece, d.rows, d.counts[BLANK], d.counts[DUPLICATE], d.counts[TRUNCATED], d.illegal, cost, d.low, d.high, d.turns,
            d.first, d.before, d.first_turn, d.last_turn, "".join(d.audit), len(d.text) if not whole else d.lines,
            None if whole else b"\n".join(d.text), d.sha.hexdigest() if whole else None,
        )

    pieces = sorted_rows.mapInArrow(search_all, PIECES.format(id=id_type))
    counts = ["rows", "turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "cost"]
    if not long:
        return pieces.select("conv_id", *counts, "audit", F.col("sha").alias("repaired_sha256"))
    # Written once, since whole conversations and the pieces of long ones take different ways.
    pieces = checkpointed(pieces)
    whole = pieces.filter("sha is not null").select("conv_id", *counts, "audit", F.col("sha").alias("repaired_sha256"))
    return whole.union(joined_pieces(pieces.filter("sha is null"), id_type, names, arrow, counts))


def joined_pieces(pieces: DataFrame, id_type: str, names: list[str], arrow: list, counts: list[str]) -> DataFrame:
    """One row per long conversation; counts add up over parts, and the hash goes over them in order."""
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    place = {n: i for i, n in enumerate(names)}

    def fold(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 4):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 4).columns))

        for conv, group in groupby(rows(), key=lambda r: r[0]):
            total = dict.fromkeys(counts, 0) | {"low": None, "high": None}
            sha, lines, audit = hashlib.sha256(), 0, []
            before, before_turn = None, None
            for r in group:
                audit.append(r[place["audit"]])
                if r[place["lines"]]:
                    if lines:
                        sha.update(b"\n")
                    sha.update(r[place["repaired"]])
                    lines += r[place["lines"]]
                if not r[place["rows"]]:
                    continue
                for c in ("rows", "turns", "blank", "duplicate", "truncated", "illegal", "cost"):
                    total[c] += r[place[c]]
                if total["low"] is None:
                    total["low"] = r[place["low"]]
                total["high"] = total["high"] if r[place["high"]] is None else r[place["high"]]
                if before is not None:
                    total["illegal"] += before + r[place["first_initial"]] not in LEGAL
                    total["turns"] -= before_turn is not None and before_turn == r[place["first_turn"]]
                before, before_turn = r[place["last_initial"]], r[place["last_turn"]]
            row = {"conv_id": conv} | total | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}
            kinds = [arrow[0], *[pa.int64()] * len(counts), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row.values(), kinds)], list(row))

    schema = f"conv_id {id_type}, " + ", ".join(f"{c} bigint" for c in counts) + ", audit string, repaired_sha256 string"
    return dealt.mapInArrow(fold, schema)
