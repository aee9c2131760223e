"""Exact token counts of every prefix of a text, by dynamic programming over last tokens."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.llm import tokenizer

NEVER = 1 << 30
# Entries of the per-process memories of words and token pairs; they are emptied when full.
WORDS_KEPT = 400_000
PAIRS_KEPT = 500_000
# Texts are counted in blocks of about this many characters.
BLOCK_CHARS = 3_000_000
# These endings are cut off as words of their own only when complete; before that their
# first two characters are an apostrophe and a letter.
ENDINGS = {"'re", "'ve", "'ll"}


class PrefixCounter:
    """Counts the tokens of all prefixes of byte strings and texts under one vocabulary.

    The encoding of a prefix ends with exactly one token, and it is the one whose own
    bytes encode to itself and which no merge would join with the token before it. So the
    count at a prefix is one more than the count at the start of its last token.
    """

    def __init__(self, path: str):
        vocab, merges, self.special = tokenizer.read_bpe(path)
        as_byte = tokenizer.printable_bytes()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            pair = vocab[left], vocab[right]
            self.rank[pair] = rank
            self.parts.setdefault(vocab[left + right], (*pair, rank))
        self._right: dict[int, tuple[tuple[int, int], ...]] = {}
        self._left: dict[int, tuple[tuple[int, int], ...]] = {}
        self.token: dict[bytes, int] = {}
        for string, token in vocab.items():
            if string not in self.special and self._reachable(token, string):
                self.token[bytes(as_byte[c] for c in string)] = token
        self.longest = max(map(len, self.token))
        self.pairs: dict[int, bool] = {}
        # The counts of a word, one byte each; None for those of over 255 tokens, which are in `long`.
        self.words: dict[str, bytes | None] = {}
        self.long: dict[str, np.ndarray] = {}
        self.split = regex.compile(tokenizer.PATTERN).findall
        self.gaps = regex.compile(r"\s{2,}(?=\S)")
        self.marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def edge(self, token: int, right: bool) -> tuple[tuple[int, int], ...]:
        """The tokens that stand at an edge while `token` is built, each with the rank that ends it."""
        memory = self._right if right else self._left
        if token not in memory:
            chain, now, ends = [], token, NEVER
            while True:
                chain.append((now, ends))
                if now not in self.parts:
                    break
                left, rest, ends = self.parts[now]
                now = rest if right else left
            memory[token] = tuple(chain)
        return memory[token]

    def joined(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether a merge of a rank under `before` goes across the border of two neighbours.

        Merges of one rank go from left to right, so one that ends the left symbol comes first.
        """
        rank = self.rank.get
        for x, x_ends in self.edge(a, True):
            for y, y_ends in self.edge(b, False):
                m = rank((x, y))
                if m is not None and m < x_ends and m <= y_ends and m < before:
                    return True
        return False

    def _reachable(self, token: int, string: str) -> bool:
        if token not in self.parts:
            return len(string) == 1
        left, right, rank = self.parts[token]
        return not self.joined(left, right, rank)

    def _extend(self, data: bytes, last: list[int], count: list[int]) -> None:
        """Carry `last` and `count`, known for the first len(count) - 1 bytes, on to the end of `data`."""
        get, longest, known = self.token.get, self.longest, self.pairs.get
        for end in range(len(count), len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = get(data[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start]
                    fits = known(before << 32 | token)
                    if fits is None:
                        fits = self.pairs[before << 32 | token] = not self.joined(before, token)
                    if not fits:
                        continue
                last.append(token)
                count.append(count[start] + 1)
                break
            else:
                raise ValueError("the vocabulary has no token for a byte")

    def _learn(self, words: set[str]) -> None:
        """Remember the counts of words; in sorted order each goes on from what it shares with the one before."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
            self.long.clear()
        if len(self.pairs) > PAIRS_KEPT:
            self.pairs.clear()
        previous, last, count = b"", [-1], [0]
        for word in sorted(words):
            data = word.encode("utf-8", "surrogatepass")
            shared = 0
            for x, y in zip(previous, data):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], count[shared + 1 :]
            self._extend(data, last, count)
            previous = data
            if len(data) == len(word):
                counts = count[1:]
            else:  # only at the ends of code points
                counts = [count[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
            if word in ENDINGS:
                counts[1] = 2
            if max(counts) < 256:
                self.words[word] = bytes(counts)
            else:
                self.words[word] = None
                self.long[word] = np.array(counts, np.int32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts at 1 .. len(text) of texts in which special strings are ordinary text; none is empty."""
        split = [self.split(text) for text in texts]
        # A run of white space gives its last character to what follows; a prefix that
        # ends with the run keeps it whole.
        gaps = [[(m.start(), m.end(), m.group()) for m in self.gaps.finditer(text)] for text in texts]
        wanted = set().union(*split, (run for found in gaps for _, _, run in found))
        if len(self.words) > WORDS_KEPT:
            self._learn(wanted)
        elif wanted := wanted - self.words.keys():
            self._learn(wanted)
        known, out = self.words.__getitem__, []
        for words, found in zip(split, gaps):
            parts = list(map(known, words))
            try:
                flat = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            except TypeError:  # some word has over 255 tokens
                arrays = [self.long[w] if p is None else np.frombuffer(p, np.uint8).astype(np.int32) for w, p in zip(words, parts)]
                flat, sizes = np.concatenate(arrays), np.array([len(a) for a in arrays])
            totals = flat[np.cumsum(sizes) - 1]
            flat += np.repeat(np.cumsum(totals, dtype=np.int32) - totals, sizes)
            for start, end, run in found:
                flat[end - 1] = (flat[start - 1] if start else 0) + int((self.long[run] if known(run) is None else known(run))[-1])
            out.append(flat)
        return out

    def count_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Token count of text[:i] for i = 0 .. len(text); special strings count as one token when complete."""
        pieces: list[str] = []
        plans = []
        for text in texts:
            plan, at = [], 0
            for mark in self.marks.finditer(text) if self.marks else ():
                # The prefixes that end inside the special string, and the text before it.
                plan.append((len(pieces), mark.start() - at, True))
                pieces.append(text[at : mark.end() - 1])
                if mark.start() > at:
                    pieces.append(text[at : mark.start()])
                at = mark.end()
            if at < len(text):
                plan.append((len(pieces), 0, False))
                pieces.append(text[at:])
            plans.append(plan)
        counted = self._plain(pieces)
        zero = np.zeros(1, np.int32)
        out = []
        for plan in plans:
            parts, base = [zero], 0
            for i, before, marked in plan:
                parts.append(counted[i] + base)
                if marked:
                    base += (int(counted[i + 1][-1]) if before else 0) + 1
                    parts.append(zero + base)
            out.append(np.concatenate(parts))
        return out

    def count_text(self, text: str) -> np.ndarray:
        return self.count_texts([text])[0]


def blocks(texts: list[str], chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Runs of whole texts of about `chars` characters together."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = tokenizer.BYTE_BPE,
    budgets: tuple[int, ...] = (),
    store: bool = True,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens and the token count at every prefix.

    `prefix_tokens[i]` is the exact count of the text's first i code points (i from 0), as
    the vocabulary's library would encode that prefix alone; `tokens_at` and `longest_within`
    answer questions on a stored table without encoding again. Each of `budgets` adds
    `fits_<budget>`, the most leading code points whose tokens are within it. `store=False`
    leaves `prefix_tokens` null. A null or empty text has no bytes and no tokens. Rows with
    null or repeated ids each give a row; other columns are ignored. No shuffle.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, prefix_tokens array<int>"
    schema += "".join(f", fits_{b} long" for b in budgets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        for batch in batches:
            sizes, totals, kept = [], [], []
            fits: list[list[int]] = [[] for _ in budgets]
            for block in blocks([t or "" for t in batch.column(1).to_pylist()]):
                for text, counts in zip(block, tokens.count_texts(block)):
                    sizes.append(len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
                    totals.append(int(counts[-1]))
                    kept.append(counts if store else None)
                    for budget, column in zip(budgets, fits):
                        within = np.flatnonzero(counts[::-1] <= budget)
                        column.append(len(counts) - 1 - int(within[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(kept, pa.list_(pa.int32())),
                    *(pa.array(c, pa.int64()) for c in fits),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "prefix_tokens", *(f"fits_{b}" for b in budgets)],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, schema)


def tokens_at(prefix_tokens: Column, code_points: Column | int) -> Column:
    """The token count of the first `code_points` of a text; of the whole text beyond its end."""
    at = F.greatest(F.lit(0), F.least(F.lit(code_points) if isinstance(code_points, int) else code_points, F.size(prefix_tokens) - 1))
    return F.get(prefix_tokens, at)


def longest_within(prefix_tokens: Column, budget: Column | int) -> Column:
    """The most leading code points of a text whose tokens are within `budget`."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    fitting = F.transform(prefix_tokens, lambda n, i: F.when(n <= limit, i))
    return F.array_max(fitting)


def count_digest(docs: DataFrame, limit: int = 512) -> DataFrame:
    """The digest columns of the registered query; the last prefix is the whole text."""
    counted = prefix_counts(docs, budgets=(limit,), store=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), f"fits_{limit}")
