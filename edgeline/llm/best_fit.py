"""Packed token-id matrices by best-fit-decreasing with a segment tree over free space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.llm import tokenizer
from edgeline.llm.pieces import END_ID, SPECIAL, cut, token_ids

CAPACITY = 2048
# A task packs whole documents in blocks of about this many tokens, which it holds in memory.
BLOCK_TOKENS = 4_000_000


class FreeSpace:
    """A segment tree over 0 .. capacity that finds the least free space of an open sequence not below a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, space: int, n: int) -> None:
        i = space + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def least(self, length: int) -> int:
        """-1 if there is none."""
        count, i = self.count, length + self.size
        if count[i]:
            return length
        # Up to the first right sibling with a sequence, then down to its leftmost one.
        while i > 1:
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of indexes: longest pieces first, each where it leaves the least space."""
    tree = FreeSpace(capacity)
    open_by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequences: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        length = lengths[i]
        space = tree.least(length)
        if space < 0:
            number, space = len(sequences), capacity
            sequences.append([])
        else:
            number = open_by_space[space].pop()
            tree.add(space, -1)
        sequences[number].append(i)
        open_by_space[space - length].append(number)
        tree.add(space - length, 1)
    return sequences


SCHEMA = (
    "sequence_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, pieces array<int>, starts array<long>"
)


def packed_matrices(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    ranks: str = tokenizer.BYTE_BPE_RANKS,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per sequence, a line of the id matrix of width `capacity`.

    input_ids: `capacity` little-endian unsigned 16-bit ids, padded with `end_id`;
    position_ids: as many 16-bit positions, which begin at 0 again with every piece and in
    the padding; cu_seqlens: 0 and the running sum of the pieces' lengths; doc_ids, pieces
    and starts: where each piece comes from, so that every document can be put together
    again. A vocabulary with larger ids, an `end_id` or a `capacity` beyond 16 bits is refused.

    A document is its ids and `end_id`; one of more than `capacity` tokens is cut into
    pieces of `capacity` after a first one that may be shorter. A null or empty text is
    `end_id` alone. Rows with null or repeated ids are packed each by itself; other
    columns are ignored. Each task packs blocks of the documents it reads, so no ids are
    shuffled; a block wastes less than half of its sequences' last one on average.
    """

    largest = max(tokenizer.rank_encoder(ranks, SPECIAL).max_token_value, end_id)
    if largest >= 1 << 16 or capacity > 1 << 16:
        raise ValueError(f"ids up to {largest} and positions up to {capacity - 1} do not fit in 16 bits")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id = TaskContext.get().partitionId() << 32
        ids: list[np.ndarray] = []
        marks: list[tuple[int | None, int, int]] = []
        size = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal sequence_id
            sequences = best_fit_decreasing([len(x) for x in ids], capacity)
            for at in range(0, len(sequences), 1000):
                some = sequences[at : at + 1000]
                matrix = np.full((len(some), capacity), end_id, "<u2")
                places = np.zeros((len(some), capacity), "<u2")
                ends = []
                for row, sequence in enumerate(some):
                    end, bounds = 0, [0]
                    for i in sequence:
                        n = len(ids[i])
                        matrix[row, end : end + n] = ids[i]
                        places[row, end : end + n] = np.arange(n)
                        end += n
                        bounds.append(end)
                    places[row, end:] = np.arange(capacity - end)
                    ends.append(bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(sequence_id, sequence_id + len(some)), pa.int64()),
                        pa.array([b[-1] for b in ends], pa.int32()),
                        pa.array([line.tobytes() for line in matrix], pa.binary()),
                        pa.array([line.tobytes() for line in places], pa.binary()),
                        pa.array(ends, pa.list_(pa.int32())),
                        pa.array([[marks[i][0] for i in s] for s in some], pa.list_(pa.int64())),
                        pa.array([[marks[i][1] for i in s] for s in some], pa.list_(pa.int32())),
                        pa.array([[marks[i][2] for i in s] for s in some], pa.list_(pa.int64())),
                    ],
                    names=["sequence_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "pieces", "starts"],
                )
                sequence_id += len(some)

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                whole = token_ids(text, ranks, end_id).astype("<u2")
                for piece, start, length in cut(len(whole), capacity):
                    ids.append(whole[start : start + length])
                    marks.append((doc, piece, start))
                size += len(whole)
                if size >= block_tokens:
                    yield from block()
                    ids, marks, size = [], [], 0
        if ids:
            yield from block()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pack, SCHEMA)
