"""Documents as token ids, cut into pieces of a sequence's capacity at most."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from edgeline.llm import tokenizer

SPECIAL = (("<|endoftext|>", 50256),)
END_ID = 0


def token_ids(text: str | None, ranks: str = tokenizer.BYTE_BPE_RANKS, end_id: int | None = END_ID) -> np.ndarray:
    """The ids of a whole text, its special strings as the library has them by default, and then `end_id`."""
    encoder = tokenizer.rank_encoder(ranks, SPECIAL)
    ids = encoder.encode(text, allowed_special="all") if text and "<|" in text else encoder.encode_ordinary(text or "")
    if end_id is not None:
        ids.append(end_id)
    return np.array(ids, np.uint32)


def cut(length: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length): whole sequences, before them what is left over; texts that fit stay whole."""
    piece, start = 0, 0
    while start < length:
        size = (length - start) % capacity or capacity
        yield piece, start, size
        piece, start = piece + 1, start + size
