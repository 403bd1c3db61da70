"""Approximate nearest neighbours by a permutation index.

Every different vector is represented by its nearest pivots in order and posted in the inverted files
of the first few of them. A query opens the files of its own nearest pivots, ranks what is posted there
by the footrule distance of the two orders, and reranks the closest by exact inner products in double
precision.

How many files are opened and up to which footrule is reranked is measured on each table: a bounded
sample of the queries is compared with all vectors exactly, and both are set so that the sample's true
neighbours are found. Clustered vectors need a few files, vectors without any clusters many.

The number of pivots grows with the root of the number of vectors. Files of pivots that lie near each
other share a unit of bounded size and a long file is cut into several, so a query goes once to each
unit that holds an open file, and neither queries nor vectors meet in a grid. Equal vectors are one
point of the index with the ids that can be answers.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import checkpointed, first_of_each

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pivots: this often the root of the number of vectors, and at most so many: they are sent to every task.
PIVOTS_PER_ROOT = 2.0
MOST_PIVOTS = 1 << 16
# Pivots of an order; a missing pivot counts as standing behind the last.
PREFIX = 32
# Files in which a vector is posted.
FILES = 2
# Queries that are compared with all vectors, and the shares of their neighbours that lie in open
# files and within the footrule that is reranked.
SAMPLE = 128
IN_FILES = 0.97
IN_FOOTRULE = 0.98
# Postings of a unit, and queries that meet a copy of it.
BLOCK = 8192
QUERY_BLOCK = 2048


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an id whose vector has the usual length, is finite and not zero."""
    kind = vectors.schema[vector].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(f"`{vector}`").cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), v.alias("v"))
    rows = rows.filter("vec_id is not null and v is not null and size(v) > 0")
    finite = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = rows.filter(f"{finite} and exists(v, x -> x != 0)")
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (usual["n"] if usual else 0))


def points_of(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(h, g, v, ids, asked): every different vector, its k + 1 smallest ids, and whether one is a query.

    Ids are limited before they are collected, so a vector that a third of all rows share is spread.
    """
    named = rows.select(F.xxhash64("v").alias("h"), F.xxhash64("v", F.lit(1)).alias("g"), "vec_id", "v")
    ids = first_of_each(named.select("h", "g", "vec_id").distinct(), ["h", "g"], ["vec_id"], k + 1)
    ids = ids.groupBy("h", "g").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    different = named.groupBy("h", "g").agg(F.first("v").alias("v"), F.bool_or(F.coalesce(is_query, F.lit(False))).alias("asked"))
    return different.join(ids, ["h", "g"]).select("h", "g", "v", "ids", "asked")


def share_of(points: DataFrame, column: str, wanted: int, n: int) -> DataFrame:
    """About ``wanted`` of ``n`` points, all if there are no more, chosen by a hash of the vector."""
    if wanted >= n:
        return points
    return points.filter(F.col(column) < int(-(2**63) + 2**64 * (wanted / n)))


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """One more component that makes all norms equal, so that the largest inner product is nearest."""
    x = x / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def directions(x: np.ndarray) -> np.ndarray:
    """Queries among lifted vectors: only their direction counts."""
    return np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))], axis=1)


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of every row, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


def by_neighbourhood(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which near ones follow each other: by the nearest of a few of them."""
    if not len(pivots):
        return np.empty(0, np.int64)
    few = pivots[: math.ceil(math.sqrt(len(pivots)))]
    nearest = few[np.argmax(pivots @ few.T, axis=1)]
    return np.lexsort((-(pivots * nearest).sum(axis=1), np.argmax(pivots @ few.T, axis=1)))


def units_of(counts: np.ndarray, sequence: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """For every pivot the first unit of its file and the number of units over which it is cut."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    unit, held = 0, 0
    for pivot in sequence:
        size = int(counts[pivot])
        if held and held + size > block:
            unit, held = unit + 1, 0
        first[pivot] = unit
        if size > block:
            parts[pivot] = -(-size // block)
            unit, held = unit + int(parts[pivot]), 0
        else:
            held += size
    return first, parts


class Files:
    """Inverted files of some vectors: per pivot the rows that are posted there, and their orders."""

    def __init__(self, own: np.ndarray, files: int):
        self.prefix = own.shape[1]
        self.pivots, slots = np.unique(own, return_inverse=True)
        slots = slots.reshape(own.shape)
        rows = np.arange(len(own))
        # The last line stands for all pivots that none of the vectors has in its order.
        # Differences of places and their sums in pairs fit the kind.
        self.kind = np.int8 if self.prefix < 64 else np.int32
        self.places = np.full((len(self.pivots) + 1, len(own)), self.prefix, self.kind)
        for place in range(self.prefix):
            self.places[slots[:, place], rows] = place
        posted = slots[:, :files].ravel()
        by_pivot = np.argsort(posted, kind="stable")
        self.rows, self.file = np.repeat(rows, min(files, self.prefix))[by_pivot], posted[by_pivot]

    def slots(self, pivots: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.pivots, pivots)
        held = at < len(self.pivots)
        held[held] = self.pivots[at[held]] == pivots[held]
        return np.where(held, at, len(self.pivots))

    def posted(self, opened: np.ndarray) -> np.ndarray:
        """The rows in the opened files."""
        is_open = np.zeros(len(self.pivots) + 1, bool)
        is_open[self.slots(opened)] = True
        found = np.zeros(self.places.shape[1], bool)
        found[self.rows[is_open[self.file]]] = True
        return np.flatnonzero(found)

    def footrule(self, order: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of the place differences between one order and those of the rows."""
        theirs = self.places[self.slots(order)].take(rows, axis=1)
        shared = np.abs(theirs - np.arange(self.prefix, dtype=self.kind)[:, None])
        shared += theirs
        shared -= self.kind(self.prefix)
        return shared.sum(axis=0, dtype=np.int32) + self.prefix * (self.prefix + 1) // 2


def narrow(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches whose distances to ``width`` pivots take 16 MB."""
    step = max(1, (1 << 21) // max(1, width))
    for b in batches:
        for start in range(0, b.num_rows, step):
            yield b.slice(start, step)


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks] or [np.empty(0)])
    return flat.astype(kind).reshape(len(column), -1)


def arrays(rows: np.ndarray) -> pa.Array:
    """A matrix as an array of lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


class Index:
    """What every task knows: the pivots, and later how the files are dealt. Its size is bounded by them."""

    def __init__(self, pivots: np.ndarray, largest: float, k: int, repeats: int, prefix: int, files: int):
        self.largest, self.k = largest, k
        self.pivots = lifted(pivots, largest) if len(pivots) else np.zeros((0, 1))
        self.prefix, self.files = min(prefix, len(self.pivots)), min(files, len(self.pivots))
        # So many different vectors hold k ids beside the query's own.
        self.least = (k + 1) * repeats
        self.opened, self.upto = len(self.pivots), self.prefix * (self.prefix + 1)

    def ordered(self, points: DataFrame) -> DataFrame:
        """``points`` with the order of every vector, checkpointed."""
        schema = T.StructType([*points.schema.fields, *T._parse_datatype_string("places array<int>").fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in narrow(batches, len(self.pivots)):
                own = orders(lifted(matrix(b.column("v")), self.largest), self.pivots, self.prefix)
                yield pa.RecordBatch.from_arrays([*b.columns, arrays(own)], schema.names)

        return checkpointed(points.mapInArrow(run, schema))

    def measure(self, points: DataFrame, n_asked: int) -> None:
        """Set how many files are opened and which footrule is reranked, by a sample of the queries."""
        sample = share_of(points.filter("asked"), "h", SAMPLE, n_asked).select("h", "g", "v").collect()
        if not sample:
            return
        y = np.array([r["v"] for r in sample], float)
        names = np.array([(r["h"], r["g"]) for r in sample], np.int64)
        k = self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = [(np.empty(0), np.empty((0, self.prefix), np.int32)) for _ in y]
            for b in batches:
                scores, own = matrix(b.column("v")) @ y.T, matrix(b.column("places"), np.int32)
                h, g = (b.column(c).to_numpy() for c in ("h", "g"))
                for i, (kept, held) in enumerate(best):
                    others = np.flatnonzero((h != names[i, 0]) | (g != names[i, 1]))
                    s = np.concatenate([kept, scores[others, i]])
                    top = np.argsort(-s, kind="stable")[:k]
                    new = top >= len(kept)
                    o = np.empty((len(top), self.prefix), np.int32)
                    o[~new], o[new] = held[top[~new]], own[others[top[new] - len(kept)]]
                    best[i] = (s[top], o)
            for i, (s, o) in enumerate(best):
                if len(s):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i)), pa.array(s), arrays(o)], ["i", "score", "places"])

        near = points.mapInArrow(run, "i bigint, score double, places array<int>")
        rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score")))
        near = near.withColumn("r", rank).filter(F.col("r") <= k).collect()
        own = orders(directions(y), self.pivots, len(self.pivots))
        files, distances = [], []
        for i, order in enumerate(own):
            theirs = np.array([r["places"] for r in near if r["i"] == i], np.int32)
            if len(theirs):
                files.extend(np.argsort(order)[theirs[:, : self.files]].min(axis=1).tolist())
                distances.extend(Files(theirs, self.files).footrule(order[: self.prefix], np.arange(len(theirs))).tolist())
        if files:
            self.opened = int(np.quantile(files, IN_FILES, method="higher")) + 1
            self.upto = int(np.quantile(distances, IN_FOOTRULE, method="higher"))

    def deal(self, points: DataFrame) -> None:
        """Put the files into units of bounded size, and count the queries of each unit."""
        self.counts = np.zeros(len(self.pivots), np.int64)
        files = lambda b: matrix(b.column("places"), np.int32)[:, : self.files].ravel()
        for r in tally(points, files).collect():
            self.counts[r["n"]] = r["count"]
        self.first, self.parts = units_of(self.counts, by_neighbourhood(self.pivots), BLOCK)
        self.copies = np.ones(int((self.first + self.parts).max(initial=1)), np.int64)
        units = tally(points.filter("asked"), lambda b: np.concatenate([u for u, _ in self.visits(b)[1]]), len(self.pivots))
        for r in units.collect():
            self.copies[r["n"]] = -(-r["count"] // QUERY_BLOCK)

    def visits(self, b: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[np.ndarray, list[np.ndarray]]]]:
        """The orders of a batch of queries; for each its units and the files that it opens there."""
        own = orders(directions(matrix(b.column("v"))), self.pivots, len(self.pivots))
        # Never so few files that there might be less than k answers.
        enough = (np.cumsum(self.counts[own], axis=1) < self.files * self.least).sum(axis=1) + 1
        out = []
        for order, n in zip(own, np.maximum(enough, self.opened)):
            opened = order[:n]
            parts = self.parts[opened]
            files = np.repeat(opened, parts)
            step = np.arange(len(files)) - np.repeat(np.cumsum(parts) - parts, parts)
            units, at = np.unique(np.repeat(self.first[opened], parts) + step, return_inverse=True)
            out.append((units, [files[at == i] for i in range(len(units))]))
        return own[:, : self.prefix], out

    def postings(self, points: DataFrame) -> DataFrame:
        """(unit, part, ids, v, places): a vector once per unit that holds a file of it, and per copy of that unit."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = matrix(b.column("places"), np.int32)[:, : self.files]
                salt = b.column("h").to_numpy().astype(np.uint64)[:, None]
                units = self.first[own] + (salt % self.parts[own].astype(np.uint64)).astype(np.int64)
                units.sort(axis=1)
                again = np.zeros(units.shape, bool)
                again[:, 1:] = units[:, 1:] == units[:, :-1]
                rows, column = np.nonzero(~again)
                units = units[rows, column]
                copies = self.copies[units]
                rows, units = np.repeat(rows, copies), np.repeat(units, copies)
                part = np.arange(len(rows)) - np.repeat(np.cumsum(copies) - copies, copies)
                taken = [b.column(c).take(pa.array(rows)) for c in ("ids", "v", "places")]
                yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(part), *taken], ["unit", "part", "ids", "v", "places"])

        v = points.schema["v"].dataType.simpleString()
        return points.mapInArrow(run, f"unit bigint, part bigint, ids array<bigint>, v {v}, places array<int>")

    def questions(self, points: DataFrame) -> DataFrame:
        """(unit, part, h, g, v, places, opened): a query once per unit that holds a file it opens."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in narrow(batches, len(self.pivots)):
                own, visits = self.visits(b)
                rows = np.repeat(np.arange(len(visits)), [len(u) for u, _ in visits])
                units = np.concatenate([u for u, _ in visits])
                part = (b.column("g").to_numpy()[rows].astype(np.uint64) % self.copies[units].astype(np.uint64)).astype(np.int64)
                opened = pa.array([f for _, files in visits for f in files], pa.list_(pa.int32()))
                taken = [b.column(c).take(pa.array(rows)) for c in ("h", "g", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(part), *taken, arrays(own[rows]), opened], names)

        names = ["unit", "part", "h", "g", "v", "places", "opened"]
        v = points.schema["v"].dataType.simpleString()
        kinds = f"unit bigint, part bigint, h bigint, g bigint, v {v}, places array<int>, opened array<int>"
        return points.filter("asked").mapInArrow(run, kinds)

    def answers(self, posted: pa.Table, asked: pa.Table) -> pa.Table:
        """(h, g, vec_id, score): the best k + 1 ids of a unit for every query that came to it."""
        out = {"h": [], "g": [], "vec_id": [], "score": []}
        if posted.num_rows and asked.num_rows:
            x, ids = matrix(posted.column("v")), posted.column("ids").to_pylist()
            files = Files(matrix(posted.column("places"), np.int32), self.files)
            own, opened = matrix(asked.column("places"), np.int32), asked.column("opened").to_pylist()
            h, g, y = asked.column("h").to_numpy(), asked.column("g").to_numpy(), matrix(asked.column("v"))
            smallest = np.array([i[0] for i in ids])
            for i in range(len(y)):
                rows = files.posted(np.array(opened[i], np.int32))
                distance = files.footrule(own[i], rows)
                # All within the measured footrule, and the closest ones where these are too few.
                if len(rows) > self.least:
                    last = max(self.upto, int(np.partition(distance, self.least - 1)[self.least - 1]))
                    rows = rows[distance <= last]
                scores = x[rows] @ y[i]
                if len(rows) > self.least:
                    among = scores >= np.partition(scores, len(rows) - self.least)[len(rows) - self.least]
                    rows, scores = rows[among], scores[among]
                best, last_score = {}, -math.inf
                for j in np.lexsort((smallest[rows], -scores)):
                    if len(best) > self.k and scores[j] < last_score:
                        break
                    for vec_id in ids[rows[j]]:
                        best.setdefault(vec_id, float(scores[j]))
                    last_score = scores[j]
                top = sorted(best.items(), key=lambda b: (-b[1], b[0]))[: self.k + 1]
                out["h"].append(np.full(len(top), h[i]))
                out["g"].append(np.full(len(top), g[i]))
                out["vec_id"].append(np.array([t[0] for t in top], np.int64))
                out["score"].append(np.array([t[1] for t in top], float))
        kinds = {"h": pa.int64(), "g": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in out.items()})


def tally(points: DataFrame, numbers_of: Callable[[pa.RecordBatch], np.ndarray], width: int = 1) -> DataFrame:
    """(n, count): how often each number comes from the batches, summed batch by batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in narrow(batches, width):
            n, count = np.unique(numbers_of(b), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(count, pa.int64())], ["n", "count"])

    return points.mapInArrow(run, "n bigint, count bigint").groupBy("n").agg(F.sum("count").alias("count"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    prefix: int = PREFIX,
    files: int = FILES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query``
    (an expression over ``vec_id``) holds, among all rows of other ids.

    Ranks run from 1 by inner product, ties by the smaller id. Vectors that are null, zero, of an
    unusual length or hold null or non-finite components, and rows without an id, take no part. A
    repeated id counts once, with its best score, as an answer; as a query with several vectors it is
    ranked by the best score of each answer over them. With fewer candidates than k all are returned;
    an empty table gives no row. Other columns are not read.
    """
    rows = usable(vectors, id_column, vector)
    points = checkpointed(points_of(rows, is_query, k))
    named = rows.select("vec_id", F.xxhash64("v").alias("h"), F.xxhash64("v", F.lit(1)).alias("g")).distinct()
    repeats = named.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    got = points.agg(
        F.count("*").alias("n"),
        F.max(F.expr("aggregate(v, 0d, (s, x) -> s + double(x) * double(x))")).alias("largest"),
        F.count_if("asked").alias("asked"),
    ).first()
    n_pivots = min(MOST_PIVOTS, max(prefix, math.ceil(PIVOTS_PER_ROOT * math.sqrt(got["n"]))))
    pivots = [r["v"] for r in share_of(points, "g", n_pivots, got["n"]).select("v", "g").orderBy("g").collect()]
    index = Index(np.array(pivots, float), math.sqrt(got["largest"] or 1.0), k, repeats, prefix, files)
    points = index.ordered(points)
    index.measure(points, got["asked"])
    index.deal(points)

    left, right = index.postings(points).groupBy("unit", "part"), index.questions(points).groupBy("unit", "part")
    meet = lambda posted, asked: index.answers(posted, asked)
    found = left.cogroup(right).applyInArrow(meet, "h bigint, g bigint, vec_id bigint, score double")
    # A query's answers come from the units it went to, so their number is bounded.
    found = found.repartition("h", "g").groupBy("h", "g", "vec_id").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("h", "g").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("r", best).filter(F.col("r") <= k + 1)
    found = found.groupBy("h", "g").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("near"))
    asked = named.filter(is_query).withColumnRenamed("vec_id", "query_id").join(found, ["h", "g"])
    if repeats > 1:
        each = asked.select("query_id", F.explode("near").alias("a")).groupBy("query_id", "a.vec_id").agg(F.min("a.s").alias("s"))
        first = F.row_number().over(Window.partitionBy("query_id").orderBy("s", "vec_id"))
        each = each.withColumn("r", first).filter(F.col("r") <= k + 1)
        asked = each.groupBy("query_id").agg(F.collect_list(F.struct("s", "vec_id")).alias("near"))
    others = F.slice(F.array_sort(F.filter("near", lambda a: a["vec_id"] != F.col("query_id"))), 1, k)
    ranked = asked.select("query_id", F.posexplode(others).alias("at", "a"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "a.vec_id", (-F.col("a.s")).alias("score"))
