"""Pieces and their places: token ids against the tokenizer, places without gaps, few sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesflow.llm import packing
from salesflow.llm.tables import table

from .samples import SF, documents, no_documents, odd_documents, words


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(exact, text):
    return [*exact.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_fast_ids_are_the_tokenizers(exact):
    rng = random.Random(6)
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 \n{chr(c)}" for c in range(0x250)]
    alphabet = [chr(c) for c in range(0x250)] + [" "] * 150 + ["\n"] * 40 + list("'s'll 123...") * 5
    texts += ["".join(rng.choice(alphabet) for _ in range(300)) for _ in range(300)]
    texts += ["<|endoftext|>", "a<|endoftext|> b", "日本語 😀", " " * 5000, "x" * 5000, "", "  x"]
    encoder = packing.Encoder(packing.TOKENIZER)
    assert encoder._fast is not None
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert list(ids) == exact.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(
    ("length", "expected"),
    [(1, [(0, 1)]), (10, [(0, 10)]), (11, [(0, 1), (1, 10)]), (20, [(0, 10), (10, 10)]), (25, [(0, 5), (5, 10), (15, 10)])],
)
def test_cut(length, expected):
    assert packing.cut(length, 10) == expected


def check(exact, docs, packed, size=packing.SEQUENCE_TOKENS):
    """Every token of every document is in one piece; pieces fill sequences from 0 without a gap."""
    rows = packed.collect()
    wanted = []
    for row in docs.select("doc_id", "text").collect():
        ids = ids_of(exact, row["text"])
        for n, (start, length) in enumerate(packing.cut(len(ids), size)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            wanted.append((row["doc_id"], n, start, length, crc))
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences), -(-sum(r["length"] for r in rows) // size)


def test_given_documents(spark, exact):
    docs = table(spark, SF, "documents")
    used, least = check(exact, docs, packing.packed_documents(docs))
    assert used <= least * 1.03 + 2


def test_odd_documents(spark, exact):
    docs = odd_documents(spark)
    check(exact, docs, packing.packed_documents(docs))
    assert packing.packed_documents(no_documents(spark)).isEmpty()


def test_several_groups(spark, exact):
    docs = documents(spark, [words(i, 3 + i % 60) for i in range(400)], [i % 7 for i in range(400)])
    packed = packing.pack(packing.pieces_of(docs, size=64), 64, group_pieces=100)
    used, least = check(exact, docs, packed, 64)
    assert used <= least * 1.1 + 8


def test_each_place_is_the_best_one():
    """Against the squares of all open counts, computed for every possible gap."""
    size, rng = 40, random.Random(2)
    bins, levels = packing.SumOfSquares(size), []
    for _ in range(500):
        length = rng.randint(1, size)
        squares = {}
        for gap in {size - level for level in levels if size - level >= length}:
            after = list(levels)
            after[after.index(size - gap)] += length
            counts = np.bincount(after, minlength=size + 1)[1:size]
            squares[gap] = int((counts**2).sum())
        number, offset = bins.place(length)
        if squares:
            assert squares[size - offset] == min(squares.values())
            assert size - offset == min(g for g, s in squares.items() if s == min(squares.values()))
            assert levels[number] == offset
            levels[number] += length
        else:
            assert offset == 0 and number == len(levels)
            levels.append(length)


def test_sequences_hold_the_ids(spark, exact):
    docs = documents(spark, ["one two", "", None, words(1, 300)])
    packed = packing.pack(packing.pieces_of(docs, size=100, with_ids=True), 100)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        place = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert place == r["ids"]
        assert zlib.crc32(np.array(place, "<u4").tobytes()) == r["ids_crc32"]
