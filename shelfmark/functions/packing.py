"""Texts in packed form, for the way through a shuffle.

Spark packs what it shuffles quickly and in small blocks, which leaves two thirds of a text in prose. Packed one by one
as they are read, texts take two fifths. Spark has no expression for that, so it is done in Python, as
Arrow UDFs on the texts alone.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Workers get this module's functions with the task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CODEC = "zstd"
# Packing once for many readers, and packing on the way.
THOROUGH, QUICK = 6, 3
# A packed text begins with its length; 0 says that it follows as it is. So do texts that would shrink further than
# this, which the shuffle packs well enough: what a batch of packed texts unpacks to stays bounded.
LENGTH_BYTES, MOST = 4, 8


def _packed(text: bytes, codec: pa.Codec) -> bytes:
    small = codec.compress(text, asbytes=True)
    if len(small) >= len(text) or len(small) * MOST < len(text):
        return bytes(LENGTH_BYTES) + text
    return len(text).to_bytes(LENGTH_BYTES, "little") + small


def _unpacked(packed: bytes, codec: pa.Codec) -> bytes:
    n = int.from_bytes(packed[:LENGTH_BYTES], "little")
    return codec.decompress(packed[LENGTH_BYTES:], n, asbytes=True) if n else packed[LENGTH_BYTES:]


def pack_texts(texts: pa.Array, level: int) -> pa.Array:
    codec = pa.Codec(CODEC, level)
    return pa.array([None if t is None else _packed(t, codec) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def unpack_texts(packed: pa.Array) -> pa.Array:
    """As strings, whatever their bytes are: no text is judged or changed on its way."""
    codec = pa.Codec(CODEC)
    texts = pa.array([None if p is None else _unpacked(p, codec) for p in packed.to_pylist()], pa.binary())
    return texts.view(pa.string())


def unpack_text_lists(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, unpack_texts(lists.flatten()), mask=lists.is_null())


def pack(text: Column | str, level: int = QUICK) -> Column:
    """The text as packed bytes; null for null."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return pack_texts(texts, level)

    return packed(text)


def unpack(packed: Column | str) -> Column:
    """The text of which ``pack`` made the bytes."""

    @F.arrow_udf("string")
    def text(given: pa.Array) -> pa.Array:
        return unpack_texts(given)

    return text(packed)


def unpack_list(packed: Column | str) -> Column:
    """The texts of an array of packed ones, in order."""

    @F.arrow_udf("array<string>")
    def texts(given: pa.Array) -> pa.Array:
        return unpack_text_lists(given)

    return texts(packed)
