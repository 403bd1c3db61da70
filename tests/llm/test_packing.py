import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
tokenizer = Tokenizer.from_file(PATH)
tokenizer.encode_special_tokens = True
encoding = packing.encoding(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_tokenizer_s(text):
    assert encoding.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_are_text():
    text = "a<|endoftext|> b's  \n\n c d"
    assert encoding.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def naive_level(levels, size, window):
    best = None
    for h in range(window - size, -1, -1):
        if h and not levels[h]:
            continue
        after = list(levels)
        if h:
            after[h] -= 1
        if h + size < window:
            after[h + size] += 1
        cost = sum(x * x for x in after)
        if best is None or cost < best[0]:
            best = (cost, h)
    return best[1]


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(16)
    for doc in range(400):
        ids = np.arange(rng.randint(1, 15), dtype=np.uint32)
        assert packer.place(len(ids)) == naive_level(packer.levels.tolist(), len(ids), 16)
        packer.add(doc, ids)
        assert packer.levels[1:16].tolist() == [len(x) for x in packer.open[1:]]


def test_round_trip(make):
    rng = random.Random(2)
    texts = [None, "", "word " * 5000, *(" ".join(rng.choices(["ab", "cde", "f1", "ñu"], k=rng.randint(0, 900))) for _ in range(200)), "same", "same"]
    docs = make(*enumerate(texts)).repartition(3)
    rows = packing.pack(docs, PATH).collect()
    want = {i: [*(tokenizer.encode(t, add_special_tokens=False).ids if t else []), 0] for i, t in enumerate(texts)}
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["start"] == at and r["length"] > 0 and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
            assert r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    short = 0
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        short += at < packing.WINDOW
    # One window at most per partition stays partly filled.
    assert short <= 3


def test_null_ids_and_empty_table(make):
    assert packing.pack(make(), PATH).count() == 0
    assert [r["doc_id"] for r in packing.pack(make((None, "x")), PATH).collect()] == [None]


@pytest.mark.parametrize("window", [8, 64])
def test_other_windows(make, window):
    rows = packing.pack(make(*((i, "one two three") for i in range(50))).coalesce(1), PATH, window=window).collect()
    assert sum(r["length"] for r in rows) == 50 * (len(tokenizer.encode("one two three").ids) + 1)


# The tokenizer as the file has it: strings of added tokens are those tokens.
default = Tokenizer.from_file(PATH)
encode = packing.encoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n\n"])), max_size=8).map("".join))
def test_added_tokens_keep_their_ids(text):
    assert encode(text).tolist() == default.encode(text, add_special_tokens=False).ids


def test_pieces_hold_added_tokens(make):
    texts = ["a<|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n", "word <|endoftext|>" * 900]
    rows = packing.pack(make(*enumerate(texts)).coalesce(1), PATH).collect()
    assert default.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 275]
    for i, text in enumerate(texts):
        ids = [*default.encode(text, add_special_tokens=False).ids, 0]
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["doc_tokens"] == len(ids) and zlib.crc32(piece.tobytes()) == r["ids_crc32"]


def test_waiting_pieces_hold_their_own_ids_only():
    packer = packing.Packer(64)
    for i in range(50):
        packer.add((i, 6401), np.arange(6401 + i, dtype=np.uint32))
    waiting = [ids for level in packer.open for held in level for _, _, ids in held]
    assert waiting and all(ids.base is None for ids in waiting)
