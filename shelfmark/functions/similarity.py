"""Similarity of strings by longest common subsequence."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weights of the two parts of a match score, and the score needed for a match.
TITLE_WEIGHT = 0.6
AUTHOR_WEIGHT = 0.4
THRESHOLD = 70.0

_SLACK = 1e-6


# Workers get this module's functions with the task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ratio(a: str, b: str) -> float:
    """100 * (1 - d / (m + n)) with d = insertions + deletions; equal empty strings give 100.

    Common-subsequence length by the published bit-vector method: one integer holds one bit per
    character of ``a``, and every character of ``b`` costs a few integer operations.
    """
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & places.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    common = len(a) - open_bits.bit_count()
    return (1.0 - (total - 2 * common) / total) * 100.0


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def ratios(text: pa.Array, others: pa.Array) -> pa.Array:
    """Similarity 0..100 of one lower-cased string to each string of an array."""
    known: dict[tuple[str, str], float] = {}  # equal pairs of a batch are compared once

    def ratio(a: str, b: str | None) -> float | None:
        if b is None:
            return None
        pair = (a, b.lower())
        if pair not in known:
            known[pair] = _ratio(*pair)
        return known[pair]

    out = [
        None if one is None or many is None else [ratio(one.lower(), other) for other in many]
        for one, many in zip(text.to_pylist(), others.to_pylist(), strict=True)
    ]
    return pa.array(out, type=pa.list_(pa.float64()))


def length_bound(a: Column, b: Column) -> Column:
    """Upper bound of the similarity: the common part cannot exceed the shorter string."""
    m, n = F.char_length(F.lower(a)), F.char_length(F.lower(b))
    return F.when(m + n == 0, 100.0).otherwise(200.0 * F.least(m, n) / (m + n))


def could_match(title: Column, author: Column, other_title: Column, other_author: Column, threshold: float) -> Column:
    """False only for pairs that cannot reach the threshold; cheap, and loses no match."""
    bound = TITLE_WEIGHT * length_bound(title, other_title) + AUTHOR_WEIGHT * length_bound(author, other_author)
    return bound >= threshold - _SLACK
