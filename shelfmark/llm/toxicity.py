"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are character n-grams of words that the labelled sample ties to toxic texts; their document
frequencies are counted over all documents. The examples' unit vectors stand in an inverted index
cut into blocks, with the largest weight of every term in every block. A query visits blocks in the
order of the bound that these maxima give and stops when no block can reach its k-th neighbour, so
the neighbours are exact. Their distance-weighted votes are calibrated on the sample itself, each
example being left out of its own vote, and the nearest examples are returned as evidence.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_each, stored, with_text_columns

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bound of the labelled sample: examples per label.
PER_LABEL = 3000
# Terms: n-grams of these lengths, as many at most, present in this share of the toxic examples.
GRAMS = (4, 5, 6)
MAX_TERMS = 1024
LEAST_SHARE = 0.01
LEAST_LIFT = 4.0
LEAST_Z = 6.0
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4
# Terms that a task counts before it hands them on, and vectors whose scores it remembers.
MEMO = 400_000
SCORED = 50_000

LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").decode("utf-8", "replace").lower().encode().translate(LETTERS).split()


def grams_of(word: bytes) -> set[str]:
    """N-grams of a word; a blank marks its ends."""
    marked = f" {word.decode('utf-8', 'replace')} "
    return {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


class Terms:
    """Finds all terms in a text in one pass of an automaton."""

    def __init__(self, numbers: dict[str, int]):
        self.automaton = ahocorasick.Automaton()
        for term, number in numbers.items():
            self.automaton.add_word(term, number)
        if numbers:
            self.automaton.make_automaton()
        self.empty = not numbers

    def count(self, text: bytes | None) -> dict[int, int]:
        words = words_of(text)
        if self.empty or not words:
            return {}
        marked = b" ".join([b"", *words, b""]).decode("utf-8", "replace")
        return Counter(number for _, number in self.automaton.iter(marked))


class Model:
    """Examples' vectors in a block-max inverted index, and the calibration of votes."""

    def __init__(self, terms: list[str], idf: np.ndarray, examples: list[tuple[int, int, dict[int, int]]], totals: dict[int, int]):
        self.numbers = {t: i for i, t in enumerate(terms)}
        self.idf = idf
        vectors = [self.vector(counts) for _, _, counts in examples]
        drawn = Counter(y for _, y, _ in examples)
        # A label's examples stand for all its labelled rows.
        stands = {y: totals.get(y, 0) / n for y, n in drawn.items()}
        blank = [stands[y] * y for (_, y, _), (ids, _) in zip(examples, vectors) if not len(ids)]
        everyone = [stands[y] for (_, y, _), (ids, _) in zip(examples, vectors) if not len(ids)]
        weight_all = sum(stands[y] for _, y, _ in examples)
        prior = sum(stands[y] * y for _, y, _ in examples) / weight_all if weight_all else 0.0
        self.unknown = (sum(blank) + prior) / (sum(everyone) + 1)
        kept = [(e, v) for e, v in zip(examples, vectors) if len(v[0])]
        # Blocks of examples whose heaviest terms are alike have tighter maxima.
        kept.sort(key=lambda x: (int(x[1][0][x[1][1].argmax()]), x[0][0]))
        self.ids = np.array([e[0] for e, _ in kept], np.int64)
        self.labels = np.array([e[1] for e, _ in kept], np.float64)
        # Postings by term, then example; a term's postings of a block lie between two offsets.
        self.n_blocks = -(-len(kept) // BLOCK)
        term = np.concatenate([v[0] for _, v in kept] or [np.empty(0, np.int64)])
        self.weights = np.concatenate([v[1] for _, v in kept] or [np.empty(0)])
        self.rows = np.repeat(np.arange(len(kept)), [len(v[0]) for _, v in kept])
        order = np.lexsort((self.rows, term))
        term, self.rows, self.weights = term[order], self.rows[order], self.weights[order]
        cell = term * self.n_blocks + self.rows // BLOCK
        self.offsets = np.searchsorted(cell, np.arange(len(terms) * self.n_blocks + 1))
        self.most = np.zeros(len(terms) * self.n_blocks)
        np.maximum.at(self.most, cell, self.weights)
        self.most = self.most.reshape(len(terms), self.n_blocks)
        self.steps = np.array([0.0]), np.array([prior])
        if len(kept):
            raw = [self.vote(*v, without=row)[0] for row, (_, v) in enumerate(kept)]
            self.steps = isotonic(np.array(raw), self.labels, np.array([stands[e[1]] for e, _ in kept]))

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(sorted(counts), np.int64)
        weights = np.array([(1 + math.log(counts[i])) * self.idf[i] for i in ids.tolist()])
        norm = math.sqrt(float(weights @ weights))
        return (ids, weights / norm) if norm else (ids[:0], weights[:0])

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest cosine, (cosine, row), ties to the smaller row; none of cosine 0."""
        if not len(ids) or not len(self.labels):
            return []
        bounds = weights @ self.most[ids]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        # The blocks of the largest bounds first; then all others that can still reach the k-th.
        best = self.closest(order[:FIRST_BLOCKS], ids, weights, k, without)
        rest = order[FIRST_BLOCKS:]
        if len(best) == k:
            rest = rest[bounds[rest] >= best[-1][0] - 1e-9]
        if len(rest):
            best = sorted(best + self.closest(rest, ids, weights, k, without), key=lambda x: (-x[0], x[1]))[:k]
        return best

    def closest(self, blocks: np.ndarray, ids: np.ndarray, weights: np.ndarray, k: int, without: int) -> list[tuple[float, int]]:
        """The k largest cosines among the examples of some blocks."""
        cells = (ids[:, None] * self.n_blocks + blocks[None, :]).ravel()
        sizes = self.offsets[cells + 1] - self.offsets[cells]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.offsets[cells] - (ends - sizes), sizes)
        parts = self.weights[at] * np.repeat(np.repeat(weights, len(blocks)), sizes)
        scores = np.bincount(self.rows[at], parts, minlength=len(self.labels)).round(12)
        if without >= 0:
            scores[without] = 0
        found = np.flatnonzero(scores > 0)
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], -k)[-k]]
        found = found[np.lexsort((found, -scores[found]))][:k]
        return list(zip(scores[found].tolist(), found.tolist()))

    def vote(self, ids: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, list[tuple[float, int]]]:
        """Votes weighted by closeness, cosine over distance; a faint prior vote for clean."""
        near = self.nearest(ids, weights, NEIGHBOURS, without)
        power = [c / (1.05 - min(c, 1.0)) for c, _ in near]
        return sum(p * self.labels[r] for p, (_, r) in zip(power, near)) / (sum(power) + 0.25), near

    def score(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        ids, weights = self.vector(counts)
        if not len(ids):
            return self.unknown, []
        vote, near = self.vote(ids, weights)
        evidence = [{"doc_id": int(self.ids[r]), "toxic": int(self.labels[r]), "cosine": c} for c, r in near[:3]]
        return float(min(1.0, max(0.0, np.interp(vote, *self.steps)))), evidence


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A non-decreasing step fit of y by x (pool adjacent violators), as points to interpolate."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, weight, sum of x, n
    for v, t, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        blocks.append([t * w, w, v, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[3] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def sample(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of labelled texts, (i, y, text), and the number of labelled rows per label.

    One label per id: toxic if any of its rows says so. Rows come in the order of a hash of the id.
    """
    named = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    one = named.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("y"))
    totals = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    hashed = one.select(F.col("doc_id").alias("i"), "y", F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
    chosen = first_of_each(hashed, ["y"], ["h", "i"], per_label).select("i", "y")
    texts = docs.select(F.col("doc_id").alias("i"), F.col("text"))
    # At most 2 * per_label ids of 16 bytes.
    return texts.join(F.broadcast(chosen), "i"), totals


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, n1, n0): different sample texts of either label that have the term."""

    def run(batches):
        seen: dict[str, list[int]] = {}

        def out():
            kinds = [pa.string(), pa.int64(), pa.int64()]
            columns = [list(seen), [v[0] for v in seen.values()], [v[1] for v in seen.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "n1", "n0"])

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams: set[str] = set()
                for word in set(words_of(text)):
                    grams |= grams_of(word)
                for g in grams:
                    seen.setdefault(g, [0, 0])[1 - y] += 1
                if len(seen) > MEMO:
                    yield out()
                    seen.clear()
        yield out()

    distinct = texts.dropDuplicates(["y", "text"]).select("y", F.col("text").cast("binary").alias("text"))
    counted = distinct.mapInArrow(run, "term string, n1 bigint, n0 bigint")
    return counted.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def choose_terms(texts: DataFrame) -> list[str]:
    """The terms that tell toxic sample texts from others best, by a two-proportion z score."""
    sizes = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.countDistinct("text").alias("n")).collect()}
    a, b = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    share1, share0 = F.col("n1") / F.lit(a), F.col("n0") / F.lit(b)
    pooled = (F.col("n1") + F.col("n0")) / F.lit(a + b)
    spread = F.sqrt(pooled * (1 - pooled) * F.lit(1 / a + 1 / b))
    good = term_counts(texts).filter((share1 >= LEAST_SHARE) & (share1 >= LEAST_LIFT * share0) & (F.col("n1") >= 3))
    z = F.when(spread > 0, (share1 - share0) / spread).otherwise(F.lit(0.0))
    best = good.withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(MAX_TERMS)
    return sorted(r["term"] for r in best.collect())


def document_frequencies(docs: DataFrame, numbers: dict[str, int]) -> tuple[np.ndarray, int]:
    """How many of all documents have each term, and how many there are."""
    kind = pa.list_(pa.struct([("t", pa.int64()), ("k", pa.int64())]))

    def make():
        terms = Terms(numbers)

        def count(texts):
            total: Counter[int] = Counter()
            for t in texts:
                total.update(terms.count(t).keys())
            total[-1] = len(texts)
            return [pa.array([[{"t": t, "k": k} for t, k in total.items()]] + [[]] * (len(texts) - 1), kind)]

        return count

    counted = with_text_columns(docs, make, "counts array<struct<t:bigint,k:bigint>>", keep=[])
    each = counted.select(F.explode("counts").alias("c")).groupBy("c.t").agg(F.sum("c.k").alias("k")).collect()
    got = {r["t"]: r["k"] for r in each}
    return np.array([got.get(i, 0) for i in range(len(numbers))], float), got.get(-1, 0)


def example_counts(texts: DataFrame, numbers: dict[str, int]) -> list[tuple[int, int, dict[int, int]]]:
    kind = pa.list_(pa.struct([("t", pa.int64()), ("k", pa.int64())]))

    def make():
        terms = Terms(numbers)
        return lambda batch: [pa.array([[{"t": t, "k": k} for t, k in sorted(terms.count(x).items())] for x in batch], kind)]

    once = texts.groupBy("y", "text").agg(F.min("i").alias("i"))
    rows = with_text_columns(once, make, "counts array<struct<t:bigint,k:bigint>>", keep=["i", "y"]).select("row.i", "row.y", "counts")
    return sorted(((r["i"], r["y"], {c["t"]: c["k"] for c in r["counts"]}) for r in rows.collect()), key=lambda x: x[:2])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_label: int = PER_LABEL) -> Model:
    """A model from labels (doc_id, toxic) where ``learn`` holds and the texts of ``docs``.

    Only the labelled sample is bounded (``per_label`` texts of each label); frequencies count every
    document. Labels that are null, or of unknown documents, teach nothing.
    """
    texts, totals = sample(docs, labels, F.lit(True) if learn is None else learn, per_label)
    texts = stored(texts.filter(F.col("text").isNotNull()), "toxicity-sample")
    terms = choose_terms(texts)
    frequency, n = document_frequencies(docs, {t: i for i, t in enumerate(terms)})
    idf = np.log((1 + n) / (1 + frequency)) + 1
    numbers = {t: i for i, t in enumerate(terms)}
    return Model(terms, idf, example_counts(texts, numbers), totals)


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the kept columns), ``score`` and ``evidence``, without a shuffle.

    Null, empty and wordless texts, and texts without any term, have the share of toxic ones among
    such examples. Evidence lists the nearest examples: doc_id, toxic, cosine. Repeated rows get
    equal results; an empty table gives none.
    """
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))

    def make():
        terms = Terms(model.numbers)
        known: dict[tuple, tuple[float, list[dict]]] = {}

        def one(text):
            counts = terms.count(text)
            key = tuple(sorted(counts.items()))
            if key not in known:
                if len(known) >= SCORED:
                    known.clear()
                known[key] = model.score(counts)
            return known[key]

        def score(texts):
            found = [one(t) for t in texts]
            return [pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], kind)]

        return score

    return with_text_columns(docs, make, "score double, evidence array<struct<doc_id:bigint,toxic:int,cosine:double>>", text, keep)
