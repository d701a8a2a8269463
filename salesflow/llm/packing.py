"""Packing of tokenised documents into sequences by the sum-of-squares rule.

Documents become token ids, long ones are cut, and each piece goes where the sum of the squared
numbers of open sequences per residual gap gets smallest. The rule keeps no gap frequent, so that a
later piece nearly always finds one that it fills.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.tables import id_and_text
from salesflow.sources.workspace import saved

SEQUENCE_TOKENS = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
# Pieces packed by one task; its open sequences are what it holds in memory.
GROUP_PIECES = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Texts tokenised at once.
_TEXTS = 64


def _file(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as the tokenizer file gives them.

    The same vocabulary as a rank file next to it is several times faster to encode with. It serves
    texts of Latin letters without the special tokens and without words or white space that run on
    for thousands of characters; there both give the same ids. The others take the slower way.
    """

    _other = re.compile("[^\x00-ɏ]|\\s{1000}")

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        path = _file(name)
        self._exact = Tokenizer.from_file(path)
        ranks = f"{os.path.splitext(path)[0]}.tiktoken"
        self._fast, self._special = None, None
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
            )
            with open(path, encoding="utf-8") as content:
                added = [t["content"] for t in json.load(content)["added_tokens"]]
            self._special = re.compile("|".join(map(re.escape, added))) if added else None

    def _plain(self, text: str) -> bool:
        return not (
            self._other.search(text)
            or (self._special and self._special.search(text))
            or max(map(len, text.split()), default=0) >= 1000
        )

    def ids(self, texts: list[str]) -> list:
        if self._fast is None:
            return [e.ids for e in self._exact.encode_batch(texts, add_special_tokens=False)]
        return [
            self._fast.encode_ordinary(t)
            if self._plain(t)
            else self._exact.encode(t, add_special_tokens=False).ids
            for t in texts
        ]


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first can be shorter than `size`."""
    if length <= size:
        return [(0, length)]
    first = length % size or size
    return [(0, first), *((start, size) for start in range(first, length, size))]


def _cut_documents(tokenizer: str, size: int, end_id: int, with_ids: bool):
    def pieces(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at in range(0, len(doc_ids), _TEXTS):
                texts = batch.column(1).slice(at, _TEXTS).to_pylist()
                rows = []
                for doc_id, ids in zip(doc_ids[at : at + _TEXTS], encoder.ids(texts), strict=True):
                    tokens = np.append(np.asarray(ids, "<u4"), np.uint32(end_id)).astype("<u4")
                    for n, (start, length) in enumerate(cut(len(tokens), size)):
                        own = tokens[start : start + length]
                        row = (doc_id, n, start, length, zlib.crc32(own.tobytes()))
                        rows.append((*row, own.astype(np.int32)) if with_ids else row)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    types, names = [*types, pa.list_(pa.int32())], [*names, "ids"]
                columns = zip(*rows, strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return pieces


def pieces_of(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, on request the ids.

    NULL and empty texts are one piece that holds the end id only. Repeated rows give their own
    pieces; a NULL doc_id stays NULL. `tokenizer` is a path or the name of a public tokenizer.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return id_and_text(docs).mapInArrow(_cut_documents(tokenizer, size, end_id, with_ids), schema)


class SumOfSquares:
    """Open sequences by residual gap, and the rule that chooses among them."""

    def __init__(self, size: int):
        self._size = size
        self._count = np.zeros(size + 1, np.int64)
        self._open: list[list[int]] = [[] for _ in range(size + 1)]
        self.sequences = 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence number and offset for a piece; among equal choices the tightest gap.

        A new sequence is opened only when the piece fits nowhere.
        """
        size, count = self._size, self._count
        here = count[length:size]
        if here.any():
            after = count[: size - length]
            # One sequence less with this gap, one more with the gap that remains, if any.
            change = 2 * (after - here) + 2
            change[0] = 1 - 2 * here[0]
            change[here == 0] = np.iinfo(np.int64).max
            gap = length + int(change.argmin())
            number = self._open[gap].pop()
            count[gap] -= 1
            self._keep(number, gap - length)
            return number, size - gap
        number = self.sequences
        self.sequences += 1
        self._keep(number, size - length)
        return number, 0

    def _keep(self, number: int, gap: int) -> None:
        if gap:
            self._count[gap] += 1
            self._open[gap].append(number)


def _pack_group(size: int):
    def packed(batches):
        group, bins = TaskContext.get().partitionId(), SumOfSquares(size)
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
            places = [bins.place(n) for n in lengths]
            sequence = pa.array([(group << 36) + number for number, _ in places], pa.int64())
            offset = pa.array([at for _, at in places], pa.int64())
            names = [*batch.schema.names, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], names)

    return packed


def pack(
    pieces: DataFrame, size: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """`pieces` with the sequence_id and offset of each.

    Pieces are dealt evenly, whatever their ids, to groups of about `group_pieces`; each group is
    packed by one task, longest pieces first and in a fixed order, and numbers its own sequences. What remains open in a
    group is a few sequences, so that more groups cost next to nothing. A full piece is a
    sequence by itself. Lengths must lie between 1 and `size`. An empty table gives an empty one.
    """
    total = pieces.count()
    groups = max(1, -(-total // group_pieces))
    order = [F.desc("length"), "doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.repartition(groups).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(_pack_group(size), f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Where each piece of each document lies; documents are tokenised once, into a table."""
    return pack(saved(pieces_of(docs, tokenizer), "pieces"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from packed pieces that carry their ids.

    A sequence is at most as long as `size`, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))
