"""Substring deduplication by recompression.

Words are symbols named by a 64-bit hash. In each round every symbol draws a bit from its name, and a
neighbouring pair (0, 1) becomes one symbol, named by the hash of both names; symbols longer than the
round's limit stay as they are. Equal neighbours draw equal bits, so a run is never cut differently
in two places: all its cuts get the run's name and are named once. Names are functions of the text
alone, so a round names runs and pairs alike in all documents without a shuffle.

After the last round the cuts between symbols depend on ``REACH`` words on either side only, and
symbols have ``LONGEST`` words at most. So every window of ``width`` words holds a cut with its whole
surroundings, and equal windows hold it at the same place. The job follows from that:

1. Each cut is announced under the name of its surroundings. Names that more than one document
   announces reveal candidates; a document learns which of its own cuts are shared.
2. Only windows around shared cuts are announced, under a 64-bit name in a bucket chosen by another
   hash, which verifies the repeat: an answer says that a smaller document has the same window.
3. The covered words are removed.

A slice of documents announces a name once and settles its own repeats at once, so a passage that a
third of all documents hold costs its bucket one entry per slice. What a slice has settled is told to
the documents by way of buckets of theirs. Entries travel packed, by hash buckets whose number follows
the measured size of the texts. No task sees more than its buckets.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 13
# Longest symbols that take part in each round; the words on either side that decide a cut after the
# last, and the most words of a symbol then.
LIMITS = (1, 2, 2)
REACH, LONGEST = 4, 4
# Words that a slice gathers before it announces, and bytes of text per bucket.
SLICE_WORDS = 1 << 20
BUCKET_BYTES = 32 << 20
LEAST_BUCKETS = 24
BUCKET = np.uint32
# Bytes of a cut's name that travel; false candidates cost little, since windows are verified.
CUT_BYTES = 5
NO_ID = (1 << 63) - 1
MEMO = 500_000

MESSAGE = "bucket int, known boolean, size int, names binary, docs binary, dk binary, places binary"
ANSWER = "d bigint, dk int, places binary"


class Names(dict):
    """Word to its name; forgets all when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name


def mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def factors(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)


def sequences(words: np.ndarray, starts: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Names of the sequences of ``width`` words at the given starts."""
    total = np.zeros(len(starts), np.uint64)
    for j, factor in enumerate(factors(width, seed)):
        total += words[starts + j] * factor
    return mixed(total)


def recompressed(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where a symbol of the last round begins; ``first`` marks the first word of a document."""
    names, place, begins = words, np.arange(len(words)), first
    for level, limit in enumerate(LIMITS):
        size = np.diff(place, append=len(words))
        bit = (mixed(names + factors(len(LIMITS), 7)[level]) >> np.uint64(17)).astype(np.uint8) & 1
        bit[size > limit] = 2
        pair = np.zeros(len(names), bool)
        pair[:-1] = (bit[:-1] == 0) & (bit[1:] == 1) & ~begins[1:]
        joined = names.copy()
        at = np.flatnonzero(pair)
        joined[at] = mixed(names[at] * np.uint64(3) + mixed(names[at + 1]))
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, place, begins = joined[keep], place[keep], begins[keep]
    return place


class Slice:
    """The words of some documents in one array."""

    def __init__(self, named: list[np.ndarray]):
        sizes = np.array([len(x) for x in named], np.int64)
        self.words = np.concatenate([*named, np.empty(0, np.uint64)])
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(named)), sizes)

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Cuts with their whole surroundings in the document, and the names of these."""
        if not len(self.words):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.zeros(len(self.words), bool)
        first[self.start[:-1][self.start[:-1] < self.start[1:]]] = True
        at = recompressed(self.words, first)
        own = self.owner[at]
        at = at[(at - REACH >= self.start[own]) & (at + REACH <= self.start[own + 1])]
        return at, sequences(self.words, at - REACH, 2 * REACH, 1)


def small(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers as differences, byte plane by byte plane, compressed."""
    steps = np.diff(values.astype(kind), prepend=np.zeros(1, kind)).astype(kind)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, steps.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def large(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def message(bucket: int, known: bool, names: np.ndarray, owners: np.ndarray, places: np.ndarray, d, dk, size: int) -> dict:
    """Entries of one bucket, ``size`` bytes of each name, none if known; a document's id is there once."""
    size = 0 if known else size
    docs, counts = np.unique(owners, return_counts=True)
    return {
        "bucket": bucket,
        "known": known,
        "size": size,
        "names": names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes(),
        "docs": small(np.concatenate([d[docs], counts]), "<i8"),
        "dk": dk[docs].astype("<i4").tobytes(),
        "places": small(places, "<u4"),
    }


def entries(m: dict) -> tuple[np.ndarray, ...]:
    """Names, ids, text keys and places of a message's entries."""
    size = m["size"]
    names = np.zeros((len(m["names"]) // size if size else 0, 8), np.uint8)
    if size:
        names[:, :size] = np.frombuffer(m["names"], np.uint8).reshape(-1, size)
    d, counts = np.split(large(m["docs"], "<i8"), 2)
    dk = np.frombuffer(m["dk"], "<i4")
    return names.view("<u8").ravel(), np.repeat(d, counts), np.repeat(dk, counts), large(m["places"], "<u4")


def announced(names, buckets, owners, places, d, dk, size: int, smaller_only: bool, n_buckets: int) -> list[dict]:
    """Messages of a slice, whose entries come by document, the documents by id.

    Names that its documents share are settled here: known to all of them or, with ``smaller_only``,
    to those with a larger id than another. One entry goes out for a name to the name's bucket; known
    ones, of which a shared passage has as many as documents, are dealt by document.
    """
    order = np.argsort(names, kind="stable")
    sorted_names, sorted_owners = names[order], owners[order]
    new = np.ones(len(names), bool)
    new[1:] = sorted_names[1:] != sorted_names[:-1]
    # A document speaks once for a name.
    once = new.copy()
    once[1:] |= sorted_owners[1:] != sorted_owners[:-1]
    order, new, sorted_owners = order[once], new[once], sorted_owners[once]
    group = np.cumsum(new) - 1
    if smaller_only:
        known = d[sorted_owners] > d[sorted_owners[new]][group]
        asks = ~known
    else:
        known = np.bincount(group)[group] > 1 if len(group) else new
        asks = new
    home = (mixed(dk.astype(np.uint64)) % np.uint64(n_buckets)).astype(BUCKET)
    out = []
    for which, is_known, buckets in ((known, True, home[owners]), (asks, False, buckets)):
        at = np.sort(order[which])
        at = at[np.argsort(buckets[at], kind="stable")]
        edges = np.flatnonzero(np.diff(buckets[at].astype(np.int64), prepend=-1)).tolist() if len(at) else []
        for lo, hi in zip(edges, [*edges[1:], len(at)]):
            x = at[lo:hi]
            out.append(message(int(buckets[x[0]]), is_known, names[x], owners[x], places[x], d, dk, size))
    return out


def answers(smaller_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Buckets come one after another; a document is told the places of its entries that are shared."""

    def settle(rows: list[dict]) -> pa.RecordBatch:
        told = [entries(r)[1:] for r in rows if r["known"]]
        asked = [entries(r) for r in rows if not r["known"]]
        if asked:
            names, d, dk, places = (np.concatenate(x) for x in zip(*asked))
            order = np.argsort(names, kind="stable")
            names = names[order]
            new = np.ones(len(names), bool)
            new[1:] = names[1:] != names[:-1]
            group = np.cumsum(new) - 1
            if smaller_only:
                keep = d[order] > np.minimum.reduceat(d[order], np.flatnonzero(new))[group]
            else:
                keep = np.bincount(group)[group] > 1
            told.append((d[order][keep], dk[order][keep], places[order][keep]))
        d, dk, places = (np.concatenate(x) for x in zip(*told))
        order = np.lexsort((places, dk, d))
        d, dk, places = d[order], dk[order], places[order].astype("<u4")
        first = np.ones(len(d), bool)
        first[1:] = (d[1:] != d[:-1]) | (dk[1:] != dk[:-1])
        heads = np.flatnonzero(first)
        body = pa.py_buffer(places.tobytes())
        offsets = pa.py_buffer((4 * np.append(heads, len(d))).astype("<i4").tobytes())
        lists = pa.Array.from_buffers(pa.binary(), len(heads), [None, offsets, body])
        return pa.RecordBatch.from_arrays([pa.array(d[heads]), pa.array(dk[heads]), lists], ["d", "dk", "places"])

    def run(batches):
        rows, bucket = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if rows and r["bucket"] != bucket:
                    yield settle(rows)
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
        if rows:
            yield settle(rows)

    return run


def gathered(packed: DataFrame, smaller_only: bool, column: str) -> DataFrame:
    """Shuffle messages by bucket, answer them, and collect a document's answers."""
    by_bucket = packed.repartition("bucket").sortWithinPartitions("bucket")
    told = by_bucket.mapInArrow(answers(smaller_only), ANSWER)
    return told.groupBy("dk", "d").agg(F.collect_list("places").alias(column))


def joined(places: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(places), "<u4").astype(np.int64)


def in_slices(batches: Iterator[pa.RecordBatch], work: Callable[[list[dict], list[np.ndarray]], list[dict]]) -> Iterator[pa.RecordBatch]:
    """Name the words of whole documents and hand them on in slices."""
    names = Names()
    schema = pa.schema(
        [("bucket", pa.int32()), ("known", pa.bool_()), ("size", pa.int32())]
        + [(c, pa.binary()) for c in ("names", "docs", "dk", "places")]
    )
    rows, named, size = [], [], 0

    def messages() -> pa.RecordBatch:
        order = sorted(range(len(rows)), key=lambda i: (rows[i]["d"], rows[i]["dk"]))
        return pa.RecordBatch.from_pylist(work([rows[i] for i in order], [named[i] for i in order]), schema)

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for r in batch.slice(at, 64).to_pylist():
                words = (r.pop("utf8") or b"").split()
                rows.append(r)
                named.append(np.fromiter(map(names.__getitem__, words), np.uint64, len(words)))
                size += len(words)
            if size >= SLICE_WORDS:
                yield messages()
                rows, named, size = [], [], 0
    if rows:
        yield messages()


def ids_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r["d"] for r in rows], np.int64), np.array([r["dk"] for r in rows], np.int64)


def without_repeats(
    docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text: str = "text", n_buckets: int | None = None
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``.

    Words are cut at ASCII white space and compared unchanged. A word is removed if a window of
    ``width`` words covers it whose sequence also starts in a document with a smaller id; windows are
    judged on the input. ``kept`` joins the remaining words by one blank. A null or empty text has
    no words, and texts of fewer words than a window lose none. A null id counts as larger than all
    others; rows of equal ids are not smaller than each other, so repeated rows are treated alike.
    An empty table gives none. Other columns are not read.
    """
    if width < 2 * REACH + LONGEST - 1:
        raise ValueError(f"windows need {2 * REACH + LONGEST - 1} words at least")
    if n_buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
        n_buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    keyed = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(F.col(f"`{text}`")).bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("dk"),
        F.col(f"`{text}`").cast("string").cast("binary").alias("utf8"),
    )

    def name_cuts(batches):
        def work(rows, named):
            part = Slice(named)
            at, names = part.cuts()
            own = part.owner[at]
            buckets = ((names >> np.uint64(40)) % np.uint64(n_buckets)).astype(BUCKET)
            return announced(names, buckets, own, at - part.start[own], *ids_of(rows), CUT_BYTES, False, n_buckets)

        yield from in_slices(batches, work)

    def name_windows(batches):
        def work(rows, named):
            part = Slice(named)
            at, names = part.cuts()
            own = part.owner[at]
            shared = np.concatenate([part.start[i] + joined(r["places"]) for i, r in enumerate(rows)])
            # All cuts of the document with the name of a shared one.
            tagged = mixed(names + factors(1, 3)[0] * own.astype(np.uint64))
            at = at[np.isin(tagged, tagged[np.isin(at, shared)])]
            own = part.owner[at]
            lo = np.maximum(at + REACH - width, part.start[own])
            hi = np.minimum(at - REACH, part.start[own + 1] - width)
            lo, hi = lo[lo <= hi], hi[lo <= hi]
            edge = np.zeros(len(part.words) + 1, np.int64)
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi + 1, -1)
            starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            own = part.owner[starts]
            windows = sequences(part.words, starts, width, 2)
            buckets = (sequences(part.words, starts, width, 5) % np.uint64(n_buckets)).astype(BUCKET)
            return announced(windows, buckets, own, starts - part.start[own], *ids_of(rows), 8, True, n_buckets)

        yield from in_slices(batches, work)

    def remove(batches):
        names = Names()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
                for r in batch.slice(at, 64).to_pylist():
                    words = (r["utf8"] or b"").split()
                    n = len(words)
                    if r["starts"]:
                        named = np.fromiter(map(names.__getitem__, words), np.uint64, n)
                        every = sequences(named, np.arange(n - width + 1), width, 2)
                        starts = np.flatnonzero(np.isin(every, every[joined(r["starts"])]))
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, starts, 1)
                        np.add.at(edge, starts + width, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                    out["doc_id"].append(r["doc_id"])
                    out["n_words"].append(n)
                    out["n_removed"].append(n - len(words))
                    out["kept"].append(b" ".join(words).decode("utf-8", "replace"))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds)], list(out))

    # The texts are shuffled once, by document, for both joins.
    shared = gathered(keyed.select("d", "dk", "utf8").mapInArrow(name_cuts, MESSAGE), False, "places")
    revealed = keyed.join(shared, ["dk", "d"])
    covered = gathered(revealed.mapInArrow(name_windows, MESSAGE), True, "starts")
    judged = keyed.join(covered, ["dk", "d"], "left")
    return judged.mapInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
