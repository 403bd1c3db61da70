"""Removal of repeated byte strings by the common-prefix interval trees of a sharded suffix array.

A suffix array of all texts would be many times their size. But two equal windows of ``width`` bytes
choose the same *anchor*: the place within the window whose following ``GRAM`` bytes have the least
hash. The windows that choose one anchor lie next to each other; with the bytes they cover they make
up a *stretch* of less than two windows. So suffixes that share ``width`` bytes start in stretches
whose anchors have the same name, and the suffix array falls into shards by name.

1. Each different stretch is announced once per slice of documents, by name and by a hash of its
   bytes. A stretch whose bytes occur earlier is covered as a whole: that settles the inside of copies.
   Of each different stretch whose name others share, the earliest goes on.
2. These few send their bytes. A shard sorts the suffixes that share ``width`` bytes, with the lengths
   of common prefixes between neighbours, and scans the array with a stack: every interval of the
   common-prefix tree comes by once, with all its occurrences. One whose left neighbours are all alike
   is part of a longer repeat and left out; the others are the maximal repeats. All their occurrences
   but the earliest are covered.
3. Covered bytes are removed.

A name with very many different stretches (a common phrase, each time in other surroundings) would
make one shard large. Its windows are dealt one by one instead, by a hash of all their bytes, and
announced once per slice; there a class of equal windows is an interval of depth ``width``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.substring import factors, large, mixed, small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 100
GRAM = 40
# Bytes looked at together, and bytes of text between two messages.
BLOCK = 1 << 17
SLICE_BYTES = 16 << 20
# Bytes of text per bucket, and different stretches of a name that go into one shard.
BUCKET_BYTES = 24 << 20
LEAST_BUCKETS = 24
MOST_STRETCHES = 2048
# Suffixes that are sorted together; a shard is cut between suffixes that share no window.
SORTED = 20_000
NO_ID = (1 << 63) - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# What a stretch is told: it is covered; send the bytes; deal the windows one by one.
COVERED, SEND, DEAL = range(3)
NAME_BYTES = 5

MESSAGE = "bucket int, kind int, n int, names binary, contents binary, docs binary, places binary, sizes binary, bytes binary"
MESSAGE_ARROW = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
MESSAGE_NAMES = [x.split()[0] for x in MESSAGE.split(", ")]
ANCHORS, BYTES, WINDOWS, SPANS = range(4)
ANSWER = "d bigint, dk bigint, places binary, kinds binary"


class Text:
    """Documents one after another, and a hash of any stretch of their bytes."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)

    def anchors(self, width: int) -> tuple[np.ndarray, ...]:
        """Stretches in order: name, hash of the content, first window, number of windows, owner."""
        step, found = BLOCK, []
        for at in range(0, max(len(self.bytes) - width + 1, 0), step):
            found.append(self.block(at, min(step, len(self.bytes) - width + 1 - at), width))
        return merged(found, self, width)

    def block(self, at: int, n: int, width: int) -> tuple[np.ndarray, ...]:
        """First windows, chosen anchors and their names, for ``n`` windows from ``at``."""
        part = self.bytes[at : at + n + width - 1]
        total, unpower = running(part)
        grams = scrambled((total[GRAM:] - total[:-GRAM]) * unpower[: len(part) - GRAM + 1])
        # The place is part of the key, so equal grams are told apart and the leftmost wins.
        key = (grams & ~np.uint64(0x3FFFF)) | np.arange(len(grams), dtype=np.uint64)
        reach, have = width - GRAM + 1, 1
        while have < reach:
            by = min(have, reach - have)
            key = np.minimum(key[:-by], key[by:])
            have += by
        own = self.owner[at : at + n]
        whole = own == self.owner[at + width - 1 : at + width - 1 + n]
        choice = (key & np.uint64(0x3FFFF)).astype(np.int64)
        first = whole.copy()
        first[1:] &= (choice[1:] != choice[:-1]) | (own[1:] != own[:-1]) | ~whole[:-1]
        starts = np.flatnonzero(first)
        ends = whole.copy()
        ends[:-1] &= (choice[1:] != choice[:-1]) | (own[1:] != own[:-1]) | ~whole[1:]
        counts = np.flatnonzero(ends) - starts + 1
        return starts + at, counts, choice[starts] + at, grams[choice[starts]]

    def windows(self, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at the given places."""
        one, two = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for at in range(0, len(starts), BLOCK // 4):
            part = slice(at, at + BLOCK // 4)
            words = [self.words(starts[part] + k) for k in (*range(0, width - 7, 8), width - 8)]
            for word, f, g in zip(words, factors(len(words), 11), factors(len(words), 13)):
                scattered = mixed(word)
                one[part] += scattered * f
                two[part] += (scattered >> np.uint64(7)) * g + word
        return mixed(one), mixed(two)

    def words(self, at: np.ndarray) -> np.ndarray:
        """Eight bytes from each place, as a number in the order of the bytes."""
        out = np.zeros(len(at), np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.bytes[at + k].astype(np.uint64)
        return out


CODE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(77))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rising powers, and those that take them back."""
    one = np.ones(1, np.uint64)
    return np.cumprod(np.append(one, np.full(n - 1, BASE))), np.cumprod(np.append(one, np.full(n - 1, UNBASE)))


def running(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the bytes' codes times rising powers, and the powers that take these back."""
    power, unpower = powers(BLOCK + 1024)
    return np.append(np.zeros(1, np.uint64), np.cumsum(CODE[part] * power[: len(part)])), unpower


def merged(found: list[tuple], text: Text, width: int) -> tuple[np.ndarray, ...]:
    """Blocks put together: a stretch that a block's end cut in two is one again."""
    if not found:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    starts, counts, choice, names = (np.concatenate(x) for x in zip(*found))
    own = text.owner[starts].astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (choice[1:] != choice[:-1]) | (own[1:] != own[:-1])
    heads = np.flatnonzero(new)
    counts = np.add.reduceat(counts, heads) if len(heads) else counts
    starts, choice, names, own = starts[heads], choice[heads], names[heads], own[heads]
    contents = np.zeros(len(starts), np.uint64)
    # A stretch is shorter than two windows, so those at its ends cover all its bytes.
    last = starts + counts - 1
    for hashes, f in zip((text.windows(starts, width), text.windows(last, width)), factors(2, 17)):
        contents += hashes[0] * f + hashes[1]
    contents = mixed(contents + (counts * 1_000_003 + choice - starts).astype(np.uint64))
    return names, contents, starts, counts, own


def packed(kind: int, buckets: np.ndarray, names, contents, owners, places, sizes, d, dk, texts=None) -> Iterator[tuple]:
    """A message for each bucket. Entries are in the order of owners; a document's ids are there once."""
    order = np.argsort(buckets, kind="stable")
    edges = np.flatnonzero(np.diff(buckets[order].astype(np.int64), prepend=-1)).tolist() if len(order) else []
    press = zstandard.ZstdCompressor(level=1)
    for lo, hi in zip(edges, [*edges[1:], len(order)]):
        x = order[lo:hi]
        docs, counts = np.unique(owners[x], return_counts=True)
        yield (
            int(buckets[x[0]]), kind, len(x),
            b"" if names is None else names[x].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NAME_BYTES].tobytes(),
            b"" if contents is None else contents[x].astype("<u8").tobytes(),
            small(np.concatenate([d[docs], dk[docs], counts]), "<i8"),
            small(places[x], "<i8"),
            b"" if sizes is None else small(sizes[x], "<i8"),
            b"" if texts is None else press.compress(b"".join(texts[i] for i in x.tolist())),
        )


def unpacked(m: dict) -> tuple[np.ndarray, ...]:
    """Ids, text keys and places of a message's entries."""
    d, dk, counts = np.split(large(m["docs"], "<i8"), 3)
    return np.repeat(d, counts), np.repeat(dk, counts), large(m["places"], "<i8")


def number(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def earlier(group: np.ndarray, d: np.ndarray, dk: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which entries have an earlier one in their group, whose entries stand together: in a smaller
    document, or at a smaller place of the same one (id and text)."""
    order = np.lexsort((places, dk, d, group))
    g, a, b, p = group[order], d[order], dk[order], places[order]
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    heads = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new[1:] |= (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first_place = p[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.zeros(len(g), bool)
    out[order] = (a > a[heads][run]) | (p > first_place)
    return out


def numbered(*keys: np.ndarray) -> np.ndarray:
    """A number per different key."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys]) if len(order) else new[1:]
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of whole documents, some megabytes at a time."""
    rows, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for r in batch.slice(at, 64).to_pylist():
                r["utf8"] = r["utf8"] or b""
                rows.append(r)
                size += len(r["utf8"])
            if size >= SLICE_BYTES:
                yield sorted(rows, key=lambda r: (r["d"], r["dk"]))
                rows, size = [], 0
    if rows:
        yield sorted(rows, key=lambda r: (r["d"], r["dk"]))


def messages(made: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Some at a time, since they carry bytes."""
    rows = []
    for m in made:
        rows.append(m)
        if len(rows) >= 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), MESSAGE_ARROW)], MESSAGE_NAMES)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), MESSAGE_ARROW)], MESSAGE_NAMES)


def ids_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r["d"] for r in rows], np.int64), np.array([r["dk"] for r in rows], np.int64)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows, bucket = [], None
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for r in batch.slice(at, 64).to_pylist():
                if rows and r["bucket"] != bucket:
                    yield rows
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
    if rows:
        yield rows


def per_document(d, dk, *columns: tuple[np.ndarray, str]) -> list[pa.Array]:
    """Arrow columns with one row per document: its ids, and its entries' values as bytes."""
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (dk[1:] != dk[:-1])
    heads = np.flatnonzero(first)
    out = [pa.array(d[heads], pa.int64()), pa.array(dk[heads], pa.int64())]
    for values, kind in columns:
        values = values.astype(kind)
        offsets = (values.itemsize * np.append(heads, len(d))).astype("<i4")
        out.append(pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]))
    return out


def judge_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each announced stretch is told; those that nothing shares are told nothing."""
    for rows in by_bucket(batches):
        told = [(*unpacked(r), np.full(r["n"], COVERED, np.int8)) for r in rows if r["kind"] == SPANS]
        asked = [r for r in rows if r["kind"] == ANCHORS]
        if asked:
            names = np.concatenate([number(r["names"], NAME_BYTES) for r in asked])
            contents = np.concatenate([np.frombuffer(r["contents"], "<u8") for r in asked])
            d, dk, places = (np.concatenate(x) for x in zip(*(unpacked(r) for r in asked)))
            content = numbered(contents, names)
            covered = earlier(content, d, dk, places)
            left = np.flatnonzero(~covered)
            # Different contents of a name.
            _, kept = np.unique(content[left], return_index=True)
            _, at = np.unique(names[left], return_inverse=True)
            different = np.bincount(at[kept])[at]
            answer = np.full(len(d), -1, np.int8)
            answer[covered] = COVERED
            answer[left[different > 1]] = SEND
            answer[left[different > MOST_STRETCHES]] = DEAL
            keep = np.flatnonzero(answer >= 0)
            told.append((d[keep], dk[keep], places[keep], answer[keep]))
        d, dk, places, answer = (np.concatenate(x) for x in zip(*told))
        if len(d):
            order = np.lexsort((places, dk, d))
            columns = per_document(d[order], dk[order], (places[order], "<i8"), (answer[order], "<i1"))
            yield pa.RecordBatch.from_arrays(columns, ["d", "dk", "places", "kinds"])


def intervals(lcp: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of all intervals of the common-prefix tree that are ``width`` deep at least.

    ``lcp[i]`` is what suffix i has in common with the one before. The stack holds the open intervals.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp.tolist(), 0]):
        first = i - 1
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, i - 1
        if depth >= width and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(data: bytes, sizes: np.ndarray, windows: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, all occurrences) of the maximal repeats of some stretches that stand in ``data``.

    Occurrences are places in ``data``. Suffixes start at the stretches' windows. The array holds those
    that share a window with another, sorted by it and then by the bytes that follow.
    """
    text = Text([data])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    ends = np.repeat(begin + sizes, windows)
    first = np.repeat(begin, windows)
    at = first + np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows)
    one, two = text.windows(at, width)
    name = numbered(two, one)
    shared = np.bincount(name)[name] > 1 if len(name) else np.zeros(0, bool)
    at, ends, first, name = at[shared], ends[shared], first[shared], name[shared]
    order = np.argsort(name, kind="stable")
    at, ends, first, name = at[order], ends[order], first[order], name[order]
    start = 0
    while start < len(at):
        upto = min(start + SORTED, len(at))
        upto = int(np.searchsorted(name, name[upto - 1], "right"))
        yield from sorted_repeats(text.bytes, at[start:upto], ends[start:upto], first[start:upto], name[start:upto], width)
        start = upto


def sorted_repeats(data, at, ends, first, name, width: int) -> Iterator[tuple[int, np.ndarray]]:
    rest = ends - at - width
    most = int(rest.max())
    after = np.zeros((len(at), -(-most // 8) * 8), np.uint8)
    for k in range(most):
        inside = np.flatnonzero(rest > k)
        after[inside, k] = data[at[inside] + width + k]
    words = after.view(">u8").astype(np.uint64) if after.shape[1] else np.zeros((len(at), 0), np.uint64)
    # An end counts as smaller than any byte: zeros stand for it, and the shorter comes first.
    order = np.lexsort((rest, *[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], name))
    at, rest, name, after, first = at[order], rest[order], name[order], after[order], first[order]
    lcp = np.zeros(len(at), np.int64)
    differ = after[1:] != after[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), after.shape[1]) if after.shape[1] else np.zeros(len(at) - 1, np.int64)
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    lcp[1:] = np.where(name[1:] == name[:-1], width + common, 0)
    # The byte on the left; each beginning of a stretch is unlike all others.
    left = np.where(at > first, data[at - 1].astype(np.int64), -1 - at)
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    for depth, lo, hi in intervals(lcp, width):
        if changes[lo] != changes[hi]:
            yield depth, at[lo : hi + 1]


def judge_bytes(width: int):
    """Spans (place, length) of documents that stand earlier, from the shards' bytes and dealt windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for rows in by_bucket(batches):
            spans = []
            sent = [r for r in rows if r["kind"] == BYTES]
            if sent:
                data = b"".join(unpress.decompress(r["bytes"]) for r in sent)
                sizes = np.concatenate([large(r["sizes"], "<i8") for r in sent])
                d, dk, places = (np.concatenate(x) for x in zip(*(unpacked(r) for r in sent)))
                begin = np.cumsum(sizes) - sizes
                covers = []
                for depth, at in maximal_repeats(data, sizes, sizes - width + 1, width):
                    of = np.searchsorted(begin, at, "right") - 1
                    covers.append((of, places[of] + at - begin[of], np.full(len(at), depth)))
                if covers:
                    group = np.repeat(np.arange(len(covers)), [len(c[0]) for c in covers])
                    of, place, length = (np.concatenate(x) for x in zip(*covers))
                    late = earlier(group, d[of], dk[of], place)
                    spans.append((d[of][late], dk[of][late], place[late], length[late]))
            dealt = [r for r in rows if r["kind"] == WINDOWS]
            if dealt:
                names = np.concatenate([np.frombuffer(r["contents"], "<u8") for r in dealt])
                d, dk, places = (np.concatenate(x) for x in zip(*(unpacked(r) for r in dealt)))
                late = earlier(numbered(names), d, dk, places)
                spans.append((d[late], dk[late], places[late], np.full(int(late.sum()), width)))
            for r in rows:
                if r["kind"] == SPANS:
                    spans.append((*unpacked(r), large(r["sizes"], "<i8")))
            if spans:
                d, dk, places, lengths = (np.concatenate(x) for x in zip(*spans))
                order = np.lexsort((places, dk, d))
                d, dk, places, lengths = united(d[order], dk[order], places[order], lengths[order])
                if len(d):
                    yield pa.RecordBatch.from_arrays(per_document(d, dk, (places, "<i8"), (lengths, "<i8")), ["d", "dk", "places", "kinds"])

    return run


def united(d, dk, places, lengths) -> tuple[np.ndarray, ...]:
    """Sorted spans of documents, those that touch put together."""
    if not len(d):
        return d, dk, places, lengths
    owner = np.ones(len(d), bool)
    owner[1:] = (d[1:] != d[:-1]) | (dk[1:] != dk[:-1])
    number_ = np.cumsum(owner) - 1
    # Far apart per document, so that one running maximum serves all.
    far = number_ * (int((places + lengths).max()) + 2)
    upto = np.maximum.accumulate(far + places + lengths)
    new = owner.copy()
    new[1:] |= (far + places)[1:] > upto[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(d)) - 1
    return d[heads], dk[heads], places[heads], upto[tails] - far[heads] - places[heads]


def joined(parts: list[bytes], kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def without_repeats(
    docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text: str = "text", n_buckets: int | None = None
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) for every row of ``docs``.

    Texts are their UTF-8 bytes. A byte is removed if a string of ``width`` bytes covers it that also
    starts earlier: in a document with a smaller id, or before it in the same document, overlaps
    included; strings are judged on the input. ``spans`` lists the removed stretches (start, length),
    ``kept`` is the remaining bytes, which need not be whole characters any more.

    A null or empty text has no bytes, and shorter texts than ``width`` lose none. A null id counts as
    larger than all others. Rows of one id and text are one document, treated alike; rows of one id
    with other texts are not earlier than each other. A very long text is one slice. An empty table
    gives no rows. Other columns are not read.
    """
    if not GRAM + 8 <= width <= 1000:
        raise ValueError(f"strings need {GRAM + 8} to 1000 bytes")
    if n_buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
        n_buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    keyed = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(F.col(f"`{text}`")).alias("dk"),
        F.col(f"`{text}`").cast("string").cast("binary").alias("utf8"),
    )

    def dealt(hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)

    def announce(batches):
        def made():
            for rows in slices(batches):
                d, dk = ids_of(rows)
                content = Text([r["utf8"] for r in rows])
                names, contents, starts, _, own = content.anchors(width)
                places = starts - content.start[own]
                late = earlier(numbered(contents, names), d[own], dk[own], places)
                # What this slice settles goes to a bucket of the document's, not of the name's.
                known = np.flatnonzero(late)
                home = dealt(mixed(dk[own[known]].astype(np.uint64)))
                yield from packed(SPANS, home, None, None, own[known], places[known], None, d, dk)
                ask = np.flatnonzero(~late)
                yield from packed(ANCHORS, dealt(mixed(names[ask])), names[ask], contents[ask], own[ask], places[ask], None, d, dk)

        yield from messages(made())

    def send(batches):
        def made():
            for rows in slices(batches):
                d, dk = ids_of(rows)
                content = Text([r["utf8"] for r in rows])
                names, _, starts, counts, own = content.anchors(width)
                told = np.full(len(starts), -1, np.int8)
                where = np.concatenate([content.start[i] + joined(r["places"]) for i, r in enumerate(rows)])
                told[np.searchsorted(starts, where)] = np.concatenate([joined(r["kinds"], "<i1") for r in rows])
                x = np.flatnonzero(told == COVERED)
                none = np.zeros(len(x), np.int64)
                who, _, place, length = united(own[x], none, starts[x] - content.start[own[x]], counts[x] + width - 1)
                yield from packed(SPANS, dealt(mixed(dk[who].astype(np.uint64))), None, None, who, place, length, d, dk)
                x = np.flatnonzero(told == SEND)
                place, length = starts[x] - content.start[own[x]], counts[x] + width - 1
                texts = [content.bytes[i : i + n].tobytes() for i, n in zip(starts[x].tolist(), length.tolist())]
                yield from packed(BYTES, dealt(mixed(names[x])), None, None, own[x], place, length, d, dk, texts)
                x = np.flatnonzero(told == DEAL)
                if len(x):
                    at = np.repeat(starts[x], counts[x]) + np.arange(counts[x].sum()) - np.repeat(np.cumsum(counts[x]) - counts[x], counts[x])
                    owners = np.repeat(own[x], counts[x])
                    places = at - content.start[owners]
                    one, two = content.windows(at, width)
                    late = earlier(numbered(two, one), d[owners], dk[owners], places)
                    k = np.flatnonzero(late)
                    full = np.full(len(k), width)
                    yield from packed(SPANS, dealt(mixed(dk[owners[k]].astype(np.uint64))), None, None, owners[k], places[k], full, d, dk)
                    k = np.flatnonzero(~late)
                    yield from packed(WINDOWS, dealt(mixed(two[k])), None, one[k], owners[k], places[k], None, d, dk)

        yield from messages(made())

    def remove(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(at, 64).to_pylist():
                    data = r["utf8"] or b""
                    spans = []
                    if r["places"]:
                        place, length = joined(r["places"]), joined(r["lengths"])
                        order = np.argsort(place, kind="stable")
                        none = np.zeros(len(order), np.int64)
                        _, _, place, length = united(none, none, place[order], length[order])
                        spans = list(zip(place.tolist(), length.tolist()))
                    kept, upto = [], 0
                    for start, length in spans:
                        kept.append(data[upto:start])
                        upto = start + length
                    kept.append(data[upto:])
                    removed = sum(n for _, n in spans)
                    out.append((r["doc_id"], len(data), removed, [{"start": s, "length": n} for s, n in spans], b"".join(kept)))
                span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def gathered(df: DataFrame, judge, first: str, second: str) -> DataFrame:
        """Shuffle messages by bucket, judge them, and collect what a document is told."""
        told = df.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(judge, ANSWER)
        return told.groupBy("dk", "d").agg(F.collect_list("places").alias(first), F.collect_list("kinds").alias(second))

    # The texts are shuffled once, by document, for both joins.
    told = gathered(keyed.select("d", "dk", "utf8").mapInArrow(announce, MESSAGE), judge_stretches, "places", "kinds")
    covered = gathered(keyed.join(told, ["dk", "d"]).mapInArrow(send, MESSAGE), judge_bytes(width), "places", "lengths")
    result = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,length:bigint>>, kept binary"
    return keyed.join(covered, ["dk", "d"], "left").mapInArrow(remove, result)
