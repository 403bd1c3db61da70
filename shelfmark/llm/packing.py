"""Sum-of-squares online packing of tokenised documents into windows.

Every task packs the documents of its partition as they come. Windows' worth of tokens are cut off
and fill windows of their own; the rest is placed at the fill level that minimises the sum over all
levels of the squared number of windows filled to that level, which a level array tracks. Only
windows still open are held. At the end of a partition the emptiest open windows are cut up to fill
the fullest ones, so that one window at most stays partly filled.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 1024
# Fixed value: how byte-level vocabularies cut texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
# Rows of a result batch, and the bits of a sequence id that number a partition's windows.
ROWS = 8192
SEQUENCE_BITS = 40


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable
    in Latin-1, else the next unused one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE vocabulary of a tokenizers file, whose ids follow the order of its merges.

    It has no added tokens; ``encoder`` splits texts at those.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    names = byte_names()
    merged = {left + right for left, right in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])}
    ranks = {
        bytes(names[c] for c in token): rank
        for token, rank in model["vocab"].items()
        if token in merged or (len(token) == 1 and token in names)
    }
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """The ids of a text as the tokenizers file gives them, without ids put around the text.

    Added tokens are cut out first, the leftmost and of those the longest; what lies between them is
    encoded piece by piece. Files whose added tokens take in blanks or need word ends are refused.
    """
    ordinary = encoding(path).encode_to_numpy
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(a.get(flag) for a in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens with single_word, lstrip or rstrip")
    ids = {a["content"]: a["id"] for a in added}
    if not ids:
        return ordinary
    cut = re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")").split

    def encode(text: str) -> np.ndarray:
        parts = cut(text)
        if len(parts) == 1:
            return ordinary(text)
        # Every second part is an added token.
        return np.concatenate([np.array([ids[p]], np.uint32) if i % 2 else ordinary(p) for i, p in enumerate(parts) if p])

    return encode


class Packer:
    """Online packing of one partition; ``add`` and ``finish`` give closed windows, lists of pieces
    (document, start, ids)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]  # by level, windows as lists of pieces

    def place(self, size: int) -> int:
        """The level to fill up: least change of the sum of squares, the fullest of equals."""
        n, last = self.levels, self.window - size
        change = 2 * n[size : self.window + 1] + 1
        change[last] = 0  # a full window has no level
        change[1:] += np.where(n[1 : last + 1] > 0, 1 - 2 * n[1 : last + 1], np.iinfo(np.int64).max // 2)
        return last - int(change[::-1].argmin())

    def add(self, doc, ids: np.ndarray) -> list[list]:
        closed = []
        whole = len(ids) - len(ids) % self.window
        for start in range(0, whole, self.window):
            closed.append([(doc, start, ids[start : start + self.window])])
        if whole < len(ids):
            size = len(ids) - whole
            level = self.place(size)
            held = self.open[level].pop() if level else []
            # A copy: a view would keep all ids of the document alive as long as its last ones wait.
            held.append((doc, whole, ids[whole:].copy()))
            if level:
                self.levels[level] -= 1
            if level + size == self.window:
                closed.append(held)
            else:
                self.open[level + size].append(held)
                self.levels[level + size] += 1
        return closed

    def finish(self) -> list[list]:
        """Fill the fullest open windows with the pieces of the emptiest, cutting where needed."""
        left = [(level, held) for level in range(self.window) for held in self.open[level]]
        closed = []
        low, high = 0, len(left) - 1
        spare: list = []
        while low <= high:
            level, held = left[high]
            high -= 1
            while level < self.window and (spare or low <= high):
                if not spare:
                    spare = left[low][1]
                    low += 1
                doc, start, ids = spare.pop()
                room = self.window - level
                held.append((doc, start, ids[:room]))
                level += min(room, len(ids))
                if len(ids) > room:
                    spare.append((doc, start + room, ids[room:]))
            closed.append(held)
        if spare:
            closed.append(spare)
        return closed


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 0, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizers file that every executor can read. A document
    is its text's ids, those of added tokens in it too, and ``end_id``; a null text counts as empty, so every row has one piece at
    least. Each partition is packed by itself, without a shuffle; sequence ids are unique over all.
    Repeated rows and rows with a null id are packed like others; an empty table gives no piece.
    """

    def run(batches):
        encode = encoder(tokenizer)
        packer, n_closed = Packer(window), 0
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        rows: list[tuple] = []

        def emit(closed):
            nonlocal n_closed
            for held in closed:
                at = 0
                for (doc, total), start, ids in held:
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
                    rows.append((doc, start, len(ids), crc, total, base + n_closed, at))
                    at += len(ids)
                n_closed += 1

        def out():
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, SCHEMA.replace(" bigint", "").split(", "))

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = t.as_py()
                ids = np.append(encode(value) if value else np.empty(0, np.uint32), np.uint32(end_id)).astype(np.uint32)
                emit(packer.add((i, len(ids)), ids))
                if len(rows) >= ROWS:
                    yield out()
        emit(packer.finish())
        yield out()

    ids = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return ids.mapInArrow(run, SCHEMA)
