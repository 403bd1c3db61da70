"""Benchmark decontamination by a prefix-filtered join of item windows with documents.

An item's windows of consecutive words are sets of shingles. For exact containment every shingle of
a window must occur in the document, so the prefix of a window that has to be joined is one token:
its rarest shingle, by the counts of all documents. A document's shingles are looked up among these
prefix tokens; a match at a place gives one start, which the length and positional bounds check
before the whole window is compared word by word.

Items are cut into overlapping pieces that together hold each window once, and the pieces are taken in
blocks of bounded size. A block's index is a few arrays, small enough for every task whatever the size
of the benchmark or of one item; further blocks are further row-local passes of the same job, and no
document is ever shuffled.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed, unpacked, with_text_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Upper bound of the UTF-8 bytes of item texts in a block: its index is collected and sent to tasks.
BLOCK_BYTES = 8 * 1024 * 1024
# Windows of a piece of an item, and comparisons of windows with places of a text that are made at a time.
PIECE = 4096
AT_A_TIME = 1 << 18
# Stands for a null id in an index.
NO_ID = -(2**63)
# Words: digits, letters and everything beyond ASCII; A-Z are lower-cased.
WORD_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class Index:
    """The different windows of a block of items as word numbers, and their shingles as numbers.

    A window shorter than ``width`` is filled up with -1. Shingles are told by a code of their words; if
    two had one code they would share a number, and the words decide in the end.
    """

    def __init__(self, items: list[tuple[int, bytes]], width: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        self.width, self.shingle = width, shingle
        windows, owners = [np.empty((0, width), np.int32)], [np.empty(0, np.int64)]
        for item, text in items:
            words = words_of(text)
            ids = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words), np.int32, len(words))
            if len(ids):
                ids = np.pad(ids, (0, max(0, width - len(ids))), constant_values=-1)
                windows.append(np.lib.stride_tricks.sliding_window_view(ids, width))
                owners.append(np.full(len(windows[-1]), item, np.int64))
        self.windows, own = np.unique(np.concatenate(windows), axis=0, return_inverse=True)
        self.lengths = (self.windows >= 0).sum(axis=1)
        pairs = np.unique(np.stack([own.ravel(), np.concatenate(owners)], axis=1), axis=0)
        self.items, self.item_ends = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        # The shingle numbers of every window by place: its own length where it is shorter than a shingle.
        self.of_window = np.full((len(self.windows), max(1, width - shingle + 1)), -1, np.int32)
        self.keys, self.n_shingles = {}, 0
        for size in range(1, min(shingle, width) + 1):
            found = []
            for at in range(self.of_window.shape[1] if size == shingle else 1):
                rows = np.flatnonzero(self.lengths >= at + size if size == shingle else self.lengths == size)
                found.append((at, rows, self._code([self.windows[rows, at + i] for i in range(size)])))
            codes, numbers = np.unique(np.concatenate([c for _, _, c in found]), return_inverse=True)
            ends = np.cumsum([len(rows) for _, rows, _ in found])
            for (at, rows, _), own in zip(found, np.split(numbers.ravel(), ends[:-1])):
                self.of_window[rows, at] = self.n_shingles + own
            if len(codes):
                self.keys[size] = (codes, self.n_shingles)
                self.n_shingles += len(codes)

    def _code(self, columns: list[np.ndarray]) -> np.ndarray:
        code = columns[0].astype(np.uint64)
        for c in columns[1:]:
            code = code * np.uint64(len(self.vocabulary) + 1) + c.astype(np.uint64)
        return code

    def ids(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        get = self.vocabulary.get
        return np.fromiter([get(w, -1) for w in words], np.int64, len(words))

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known shingles in a document, and their numbers."""
        places, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size, (codes, base) in self.keys.items():
            if len(ids) < size:
                continue
            columns = [ids[i : len(ids) - size + 1 + i] for i in range(size)]
            known = columns[0] >= 0
            for c in columns[1:]:
                known &= c >= 0
            at = np.flatnonzero(known)
            code = self._code([c[at] for c in columns])
            slot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[slot] == code
            places.append(at[hit])
            numbers.append(base + slot[hit])
        return np.concatenate(places), np.concatenate(numbers)

    def set_prefixes(self, numbers: np.ndarray, counts: np.ndarray) -> None:
        """Choose the prefix token of every window: its rarest shingle, the first of equals."""
        total = np.zeros(self.n_shingles + 1, np.int64)
        total[numbers] = counts
        total[-1] = np.iinfo(np.int64).max
        self.place = np.argmin(total[self.of_window], axis=1) if len(self.windows) else np.empty(0, np.int64)
        prefix = self.of_window[np.arange(len(self.windows)), self.place]
        self.posted = np.argsort(prefix, kind="stable")
        self.posted_ends = np.searchsorted(prefix[self.posted], np.arange(self.n_shingles + 1))
        # Only the prefixes are looked up from here on.
        del self.of_window

    def hits(self, text: bytes | None) -> tuple[int, list[dict], list[int]]:
        """Words of the document, its covered spans and the items found."""
        ids = self.ids(text)
        places, numbers = self.occurrences(ids)
        posted = self.posted_ends[numbers + 1] - self.posted_ends[numbers] if len(numbers) else numbers
        kept = posted > 0
        places, numbers, posted = places[kept], numbers[kept], posted[kept]
        spans, found = set(), [np.empty(0, np.int64)]
        upto = np.cumsum(posted)
        first = 0
        while first < len(places):
            # As many places as have few windows together, one at least.
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + AT_A_TIME, side="right")))
            n = posted[first:last]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = self.posted[np.repeat(self.posted_ends[numbers[first:last]], n) + step]
            start = np.repeat(places[first:last], n) - self.place[window]
            inside = (start >= 0) & (start + self.lengths[window] <= len(ids))
            window, start = window[inside], start[inside]
            for i in range(self.width):
                words = self.windows[window, i]
                same = (words < 0) | (words == ids[np.minimum(start + i, len(ids) - 1)])
                window, start = window[same], start[same]
            spans.update(zip(start.tolist(), (start + self.lengths[window]).tolist()))
            found.append(np.unique(window))
            first = last
        items = {i for w in np.unique(np.concatenate(found)) for i in self.items[self.item_ends[w] : self.item_ends[w + 1]].tolist()}
        return len(ids), [{"lo": a, "hi": b} for a, b in sorted(spans)], sorted(items)


def pieces(items: DataFrame, width: int) -> DataFrame:
    """(item_id, utf8): the words of each item in pieces that overlap by all but one word of a window."""

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                cuts = range(0, max(1, len(words) - width + 1), PIECE) if words else ()
                for at in cuts:
                    part = b" ".join(words[at : at + PIECE + width - 1])
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.int64()), pa.array([part], pa.binary())], ["item_id", "utf8"])

    rows = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("utf8"))
    return rows.filter("utf8 is not null").mapInArrow(run, "item_id bigint, utf8 binary").distinct()


def item_blocks(parts: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The pieces in as many hash blocks as keep each below the bound, by a measured size."""
    size = parts.agg(F.sum(F.octet_length("utf8"))).first()[0] or 0
    n = int(2 * size // block_bytes) + 1
    return [parts.filter(F.pmod(F.xxhash64("item_id", "utf8"), F.lit(n)) == i) for i in range(n)]


def with_hits(
    docs: DataFrame, items: DataFrame, width: int = 10, shingle: int = 3, text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``row`` (struct of the columns of ``docs``), ``n_words``, ``n_hit`` and ``items`` (sorted ids).

    ``items`` has ``item_id`` and ``text``. A null or wordless text has no words, and no windows as
    an item; items with a null id are not reported but their words count as hit. Repeated items and
    rows count alike, empty tables give no hits, other columns of ``docs`` pass through.
    """
    found = None
    for block in item_blocks(checkpointed(pieces(items, width)), block_bytes):
        index = Index([(NO_ID if r[0] is None else r[0], bytes(r[1])) for r in block.collect()], width, shingle)
        index.set_prefixes(*rarity(docs, index, text))
        # The rows of the pass before become the row of the next, so results add up by columns.
        found = one_pass(docs if found is None else found, index, text if found is None else f"row.{text}", found is None)
    return found.select(
        "row",
        "n_words",
        F.expr(COVERED).alias("n_hit"),
        F.array_sort(F.filter(F.array_distinct("items"), lambda i: i != NO_ID)).alias("items"),
    )


# Words under the union of sorted spans.
COVERED = """aggregate(array_sort(spans), struct(0L as n, 0L as upto),
  (s, x) -> struct(s.n + greatest(0L, x.hi - greatest(x.lo, s.upto)) as n, greatest(s.upto, x.hi) as upto),
  s -> s.n)"""


def rarity(docs: DataFrame, index: Index, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the block's shingles, and their occurrences in all documents."""

    def make():
        def count(texts):
            total = np.zeros(index.n_shingles + 1, np.int64)
            for t in texts:
                total += np.bincount(index.occurrences(index.ids(t))[1], minlength=len(total))
            seen = np.flatnonzero(total)
            return [pa.array([[{"n": int(i), "k": int(total[i])} for i in seen]] + [[]] * (len(texts) - 1), KIND)]

        return count

    KIND = pa.list_(pa.struct([("n", pa.int64()), ("k", pa.int64())]))
    counted = with_text_columns(docs, make, "counts array<struct<n:bigint,k:bigint>>", text, keep=[])
    each = counted.select(F.explode("counts").alias("c")).groupBy("c.n").agg(F.sum("c.k").alias("k"))
    counts = each.toArrow()
    return counts.column("n").to_numpy(), counts.column("k").to_numpy()


def one_pass(docs: DataFrame, index: Index, text: str, first: bool) -> DataFrame:
    def make():
        def scan(texts):
            found = [index.hits(t) for t in texts]
            return [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]

        return scan

    spans = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    kinds = [pa.int64(), spans, pa.list_(pa.int64())]
    fields = "n_words bigint, spans array<struct<lo:bigint,hi:bigint>>, items array<bigint>"
    if first:
        return with_text_columns(docs, make, fields, text)
    held = docs.select("row", F.col("spans").alias("spans0"), F.col("items").alias("items0"), F.col(text).alias("text"))
    more = with_text_columns(held, make, fields, "text", keep=["row", "spans0", "items0"])
    return more.select(
        "row.row",
        "n_words",
        F.array_union("spans", "row.spans0").alias("spans"),
        F.array_union("items", "row.items0").alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns."""
    return unpacked(with_hits(docs, items, **options).filter("n_hit = 0"))
