"""Byte-level BPE vocabularies read from tokenizer files, for use inside tasks."""

from __future__ import annotations

import json
from functools import lru_cache

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


def printable_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabulary files write the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_bpe(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int]]:
    """Vocabulary, merges in order of rank, and the special strings with their ids."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    return data["model"]["vocab"], merges, special


@lru_cache(maxsize=4)
def rank_encoder(path: str, special: tuple[tuple[str, int], ...] = ()):
    """A tiktoken encoder over a rank file; once per process."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
