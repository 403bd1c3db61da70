"""Periodic runs of words, by an online sparse diagonal scan.

A run is a stretch of words that agrees with itself ``period`` words earlier, is several periods long
and cannot be made longer on either side. On the diagonal of a lag q, a word matches if the word q
places earlier is the same; a run is a long row of matches on the diagonal of its smallest period.

The scan goes over the words of a text and asks for the earlier occurrence of each. It is sparse: a
word counts only where the whole block of words that ends with it has occurred before in the text,
since shorter rows of matches cannot make a run. A step that finds the lag of the active diagonal
adds one to its match length; any other lag ends that diagonal, and a run is emitted there and then
if it was long enough. Lags come in classes (size/2, size], each with blocks of ``size`` words. Within
a class the *nearest* earlier occurrence is the only one to follow: a nearer one inside a run would
make the run's smallest period smaller (Fine and Wilf), so one diagonal per class is active at a time
and the work is n log n at worst, also for a text that repeats one word.

Blocks are named exactly: the next class's block is the pair of two blocks, and only blocks that
occur twice in their text go on, so most texts end after the first class.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.substring import factors, mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A run has this many words and is this many periods long, at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3
# Words that are looked at together.
SLICE_WORDS = 1 << 19

FIELDS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, strongest int, collapsed string"


class Ids(dict):
    """Word to its number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def first_block(least: int, periods: int) -> int:
    """Words that match in a row on the diagonal of any run, as a power of two."""
    matches = min(max(least - q, (periods - 1) * q) for q in range(1, least + 1))
    return 1 << (max(matches, 1).bit_length() - 1)


def repeated_blocks(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a block ends that occurs elsewhere in the same text, and exact names of the blocks.

    Blocks of different texts have different names.
    """
    ends = np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1]) + size - 1 if len(owner) >= size else np.empty(0, np.int64)
    if not len(ends):
        return ends, ends
    guess = np.zeros(len(ends), np.uint64)
    base = mixed(words.astype(np.uint64) + np.uint64(1))
    for j, factor in enumerate(factors(size, 3)):
        guess += base[ends - j] * factor
    guess = mixed(guess + owner[ends].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ends = ends[several(guess)]
    # Few are left: these are named exactly, by pairs of blocks of half the size.
    name, width = words, 1
    at = np.unique((ends[:, None] - np.arange(size)).ravel())
    name = words[at]
    while width < size:
        before = np.searchsorted(at, at - width)
        there = (at >= width) & (before < len(at))
        there[there] = at[before[there]] == at[there] - width
        pair = np.full(len(at), -1, np.int64)
        pair[there] = pairs(name[before[there]], name[there])
        name, width = pair, 2 * width
    name = pairs(owner[ends], name[np.searchsorted(at, ends)])
    keep = several(name)
    return ends[keep], name[keep]


def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number per different pair."""
    b = np.unique(b, return_inverse=True)[1].astype(np.int64)
    a = np.unique(a, return_inverse=True)[1].astype(np.int64)
    width = int(b.max()) + 1 if len(b) else 1
    return np.unique(a * width + b, return_inverse=True)[1].astype(np.int64)


def several(names: np.ndarray) -> np.ndarray:
    """Which names occur more than once."""
    if not len(names):
        return np.zeros(0, bool)
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    out = np.zeros(len(names), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def diagonals(ends: list[int], names: list[int], size: int, above: int, least: int, periods: int) -> Iterator[tuple[int, int, int]]:
    """Runs (start, length, period) whose period lies in (above, size], as soon as their diagonal ends.

    ``ends`` are places in ascending order where a block of ``size`` words ends, with its name. A
    diagonal whose last ``size`` matches were one block starts with that many matches.
    """
    last: dict[int, int] = {}
    lag, matches, at = 0, 0, -2

    def ended() -> Iterator[tuple[int, int, int]]:
        length = matches + lag
        if lag and length >= max(least, periods * lag):
            yield at + 1 - length, length, lag

    for place, name in zip(ends, names):
        earlier = last.get(name)
        last[name] = place
        found = place - earlier if earlier is not None and above < place - earlier <= size else 0
        if found == lag and place == at + 1:
            matches += 1
        else:
            yield from ended()
            lag, matches = found, size
        at = place
    yield from ended()


def runs_of(words: np.ndarray, owner: np.ndarray, least: int, periods: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of the texts whose words stand one after another, by text; starts count from the slice's."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    size, above = first_block(least, periods), 0
    ends, names = repeated_blocks(words, owner, size)
    while len(ends):
        for run in diagonals(ends.tolist(), names.tolist(), size, above, least, periods):
            found.setdefault(int(owner[run[0]]), []).append(run)
        # Blocks twice as long: this block and the one right before it.
        before = np.searchsorted(ends, ends - size)
        there = ends[np.minimum(before, len(ends) - 1)] == ends - size
        there &= owner[np.maximum(ends - 2 * size + 1, 0)] == owner[ends]
        names, ends = pairs(names[before[there]], names[there]), ends[there]
        keep = several(names)
        ends, names = ends[keep], names[keep]
        above, size = size, 2 * size
    return found


def strongest(runs: list[dict]) -> int | None:
    """Place in ``runs`` of the greatest length per period, exactly; the first of equal ones."""
    best = None
    for i, r in enumerate(runs):
        if best is None or r["length"] * runs[best]["period"] > runs[best]["length"] * r["period"]:
            best = i
    return best


def judged(texts: list[bytes | None], least: int, periods: int) -> Iterator[tuple[int, list[dict], int | None, str]]:
    """(words, runs, the strongest run's place, text without repeats) of each text."""
    ids = Ids()
    words = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    numbers = np.fromiter((ids[x] for w in words for x in w), np.int64, int(start[-1]))
    found = runs_of(numbers, np.repeat(np.arange(len(words)), sizes), least, periods)
    for i, w in enumerate(words):
        runs = sorted((s - int(start[i]), n, q) for s, n, q in found.get(i, ()))
        runs = sorted(runs, key=lambda r: (r[0], r[2]))
        runs = [{"start": s, "length": n, "period": q} for s, n, q in runs]
        if runs:
            gone = np.zeros(len(w) + 1, np.int64)
            for r in runs:
                gone[r["start"] + r["period"]] += 1
                gone[r["start"] + r["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            yield len(w), runs, strongest(runs), b" ".join([w[k] for k in kept.tolist()]).decode("utf-8", "replace")
        else:
            yield len(w), runs, None, b" ".join(w).decode("utf-8", "replace")


def with_runs(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    periods: int = LEAST_PERIODS,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (a struct of the columns to keep, all by default), ``n_words``, ``runs``, ``strongest``
    and ``collapsed``; one pass, without a shuffle.

    Words are cut at ASCII white space and numbered from 0. ``runs`` are ordered by start, then period;
    ``strongest`` is the place in ``runs`` of the run with the greatest length per period, of equal ones
    the first, null without runs. ``collapsed`` joins by one blank the words that stay: a word goes if a
    run holds it after that run's first period. Runs that share words are judged each by itself.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows are treated
    alike, since each text is judged by itself. A very long text is one slice, with some 100 bytes of
    memory per word. An empty table gives no rows. Kept columns sit in ``row`` and may have any names.
    """
    if periods < 3:
        raise ValueError("runs are three periods long at least")
    keep = docs.columns if keep is None else keep
    inner = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    packed = docs.select(inner.alias("row"), F.col(f"`{text}`").cast("string").cast("binary").alias("utf8"))
    schema = T.StructType([packed.schema["row"], *T._parse_datatype_string(FIELDS).fields])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    kinds = [pa.int64(), run_type, pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # About five bytes a word.
            bytes_before = np.cumsum([0] + [x or 0 for x in pa.compute.binary_length(batch.column(1)).to_pylist()])
            start = 0
            while start < batch.num_rows:
                upto = int(np.searchsorted(bytes_before, bytes_before[start] + 5 * SLICE_WORDS, "right")) - 1
                part = batch.slice(start, max(upto - start, 1))
                out = list(judged(part.column(1).to_pylist(), least, periods))
                columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.names)
                start += part.num_rows

    return packed.mapInArrow(run, schema)
