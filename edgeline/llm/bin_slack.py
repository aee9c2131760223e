"""Packing by minimum bin slack: each sequence takes the fullest combination of the lengths there are."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.llm import tokenizer
from edgeline.llm.pieces import END_ID, cut, token_ids
from edgeline.runtime import materialize

CAPACITY = 2048
# Pieces that one task packs. Each task wastes less than one sequence on its last pieces.
TASK_PIECES = 20_000


def measured_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, ranks: str, end_id: int | None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; the ids themselves go no further."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = token_ids(text, ranks, end_id)
                for piece, start, length in cut(len(ids), capacity):
                    crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                    rows.append((doc, piece, start, length, crc))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(measure, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(stock: dict[int, int], order: list[int], room: int) -> list[int]:
    """The lengths, out of `stock` (how many there are of each), whose sum is the largest within `room`.

    Bit s of `sums` tells that some combination of the lengths so far adds up to s.
    `order` has the lengths from long to short; the search ends when `room` is met exactly.
    """
    mask = (1 << room + 1) - 1
    full = 1 << room
    sums, steps = 1, []
    for length in order:
        if length > room:
            continue
        for _ in range(min(stock[length], room // length)):
            grown = (sums | sums << length) & mask
            if grown == sums:
                break
            steps.append((length, sums))
            sums = grown
        if sums & full:
            break
    left = sums.bit_length() - 1
    taken = []
    for length, before in reversed(steps):
        if not before >> left & 1:
            taken.append(length)
            left -= length
    return taken


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of indexes into `lengths`; each starts with the longest piece left and is then filled up."""
    by_length: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by_length.setdefault(lengths[i], []).append(i)
    sequences = [[i] for i in by_length.pop(capacity, [])[::-1]]
    stock = {length: len(of) for length, of in by_length.items()}
    order = sorted(stock, reverse=True)

    def take(length: int) -> int:
        stock[length] -= 1
        if not stock[length]:
            del stock[length]
            order.remove(length)
        return by_length[length].pop()

    while order:
        first = order[0]
        sequence = [take(first)]
        sequence += [take(length) for length in fullest(stock, order, capacity - first)]
        sequences.append(sequence)
    return sequences


def pack_pieces(pieces: DataFrame, rows: int, capacity: int = CAPACITY, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to `capacity` tokens; `rows` is how many pieces there are.

    The pieces are dealt evenly to tasks of about `task_pieces`, whatever their documents,
    and each task packs its own: nothing but the lengths decides.
    """
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table["length"].to_pylist()
        base = TaskContext.get().partitionId() << 32
        order, sequence_ids, offsets = [], [], []
        for number, sequence in enumerate(pack(lengths, capacity)):
            at = 0
            for i in sequence:
                order.append(i)
                sequence_ids.append(base + number)
                offsets.append(at)
                at += lengths[i]
        table = table.take(pa.array(order, pa.int64()))
        table = table.append_column("sequence_id", pa.array(sequence_ids, pa.int64()))
        yield from table.append_column("offset", pa.array(offsets, pa.int64())).combine_chunks().to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    dealt = pieces.repartition(max(1, -(-rows // task_pieces)))
    return dealt.mapInArrow(place, f"{fields}, sequence_id long, offset long").select(*names, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    ranks: str = tokenizer.BYTE_BPE_RANKS,
    end_id: int | None = END_ID,
    task_pieces: int = TASK_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its ids and then `end_id`; only one of more than `capacity` tokens is
    cut, into pieces of `capacity` after a first one that may be shorter. A null or empty
    text is `end_id` alone, and no piece at all without one. Rows with null or repeated
    ids are packed each by itself; other columns are ignored. The texts are encoded where
    they are read, and only lengths and checksums move.
    """
    pieces, seen = materialize(measured_pieces(docs, id_col, text_col, capacity, ranks, end_id))
    return pack_pieces(pieces, seen["rows"], capacity, task_pieces)
