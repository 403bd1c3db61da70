"""Near-duplicates by SimHash with pivot distance tables.

Fingerprints of word shingles are reduced to distinct ones. Two fingerprints within the bit limit k
agree on at least t of k + t bit blocks, so distinct fingerprints meet under the values of every t
blocks; t follows from their number, so that buckets stay small. In such a bucket the Hamming distances of every fingerprint to the reference
fingerprints (pivots), computed once beforehand, are compared: by the triangle inequality a pair
whose distances to any pivot differ by more than k is discarded unseen, and only survivors are
verified. A bucket gives a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed, components, unpacked, with_text_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
# Fingerprints of a bucket that one task compares; larger buckets are cut into chunks and every
# pair of chunks is compared in a group of its own.
CHUNK = 4096
N_PIVOTS = 24


def pivots(n: int = N_PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of 0 to n - 1."""
    return [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(n)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The 64-bit SimHash of one text, signed."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return signed(xxhash.xxh64_intdigest(joined, SEED))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: -shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the kept columns) and ``fp`` (bigint); a null text counts as empty."""

    def make():
        return lambda texts: [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    return with_text_columns(docs, make, "fp bigint", text, keep)


def near(tables: np.ndarray, fps: np.ndarray, i: slice, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row in i, any row): pivot distances first, then the bits of the survivors."""
    if len(fps) <= 32:
        left = np.abs(tables[:, i, None] - tables[:, None, :]).max(axis=0) <= max_bits
    else:
        left = np.ones((i.stop - i.start, len(fps)), bool)
        for column in tables:
            left &= np.abs(column[i, None] - column[None, :]) <= max_bits
    a, b = np.nonzero(left)
    a += i.start
    keep = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= max_bits)
    return a[keep], b[keep]


def forest(fps: np.ndarray, tables: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as all links of the bucket would, n - 1 at most."""
    label = np.arange(len(fps))
    step = max(1, (1 << 20) // len(fps))
    for start in range(0, len(fps), step):
        a, b = near(tables, fps, slice(start, min(start + step, len(fps))), max_bits)
        while True:
            least = label.copy()
            np.minimum.at(least, label[a], label[b])
            np.minimum.at(least, label[b], label[a])
            new = least[label]
            new = np.minimum(new, new[new])
            if np.array_equal(new, label):
                break
            label = new
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child], fps[label[child]]


def agreeing_blocks(n: int, max_bits: int) -> int:
    """Fewest blocks, two at least, whose values tell n fingerprints apart; the links stay the same."""
    return next(t for t in range(2, 64) if 2 ** (64 * t / (max_bits + t)) >= n or max_bits + t >= 12)


def links(
    fingerprints: DataFrame,
    max_bits: int = 3,
    chunk: int = CHUNK,
    n_pivots: int = N_PIVOTS,
    agreeing: int | None = None,
) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that give the components of all links.

    Every pair of at most ``max_bits`` differing bits shares a bucket, so no link between
    components is lost at any size of a bucket.
    """
    agreeing = agreeing_blocks(fingerprints.count(), max_bits) if agreeing is None else agreeing
    n_blocks = max_bits + agreeing
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    together = [signed(sum(some)) for some in itertools.combinations(masks, agreeing)]
    refs = [signed(p) for p in pivots(n_pivots)]
    fp = F.col("fp")
    keyed = fingerprints.select(
        "fp", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m)) for m in together])).alias("blocks", "value")
    )
    sizes = keyed.groupBy("blocks", "value").agg(F.count("*").alias("n")).filter("n > 1")
    # Chunks c of a bucket: a row goes to the groups {c, other} for every other chunk.
    n_chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    distances = F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in refs])
    cut = keyed.join(sizes, ["blocks", "value"]).select(
        "blocks", "value", "fp", distances.alias("distances"), n_chunks.alias("chunks")
    )
    cut = cut.withColumn("c", F.expr("cast(pmod(xxhash64(fp), chunks) as int)"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    # With more than one chunk, a pair of rows of chunk c meets in (c, c) as well.
    group = ["blocks", "value", "lo", "hi"]
    cut = cut.select(
        "blocks", "value", F.least("c", "other").alias("lo"), F.greatest("c", "other").alias("hi"), "fp", "distances"
    )
    cut = cut.repartition(*group).sortWithinPartitions(*group)

    def run(batches):
        waiting = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                if waiting is None:
                    return
                now, waiting, last = waiting, None, True
            else:
                now = pa.Table.from_batches([batch]) if waiting is None else pa.concat_tables([waiting, pa.Table.from_batches([batch])])
                last = False
            now = now.combine_chunks()
            key = np.stack([now.column(i).to_numpy().astype(np.int64) for i in range(4)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), now.num_rows]
            whole = len(bounds) - 1 if last else len(bounds) - 2
            waiting = None if last else now.slice(bounds[whole])
            fps = now.column("fp").to_numpy()
            flat = now.column("distances").combine_chunks()
            flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
            distances = flat.flatten().to_numpy().reshape(-1, n_pivots)
            a, b = [], []
            for lo, hi in zip(bounds[:whole], bounds[1 : whole + 1]):
                x, y = forest(fps[lo:hi].view(np.uint64), np.ascontiguousarray(distances[lo:hi].T), max_bits)
                a.append(x)
                b.append(y)
            if a:
                a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return cut.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 3,
    id_column: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, fp, component_id, root) and the columns to keep for every row of ``docs``.

    Texts are lower-cased in A-Z and cut at ASCII white space. Fingerprints within ``max_bits`` are
    linked, equal ones too; ``component_id`` is the least id reachable. ``root`` is a fingerprint that
    stands for the component: ids may clash, so that two components have the same least id. Null and empty texts have
    fingerprint 0 and are linked like others. Rows with a null id take part and get the component's
    id, which is null if no member has an id. Repeated rows stay, an empty table gives none.
    """
    ids = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *keep)
    marked = checkpointed(unpacked(with_fingerprint(ids, shingle, keep=["doc_id", *keep]), F.col("fp")))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = placed.join(least, "root").select("fp", "component_id", "root")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id", "root", *keep)
