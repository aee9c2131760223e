"""BPE encoding by a word lexicon: a minimal acyclic transducer for frequent words, exact merges for the rest."""

from __future__ import annotations

import hashlib
import heapq
import io
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeline.llm import tokenizer
from edgeline.llm.shared_files import is_shared, write_shared
from edgeline.llm.token_counts import blocks
from edgeline.runtime import materialize

# Fixed value: the vocabulary's own rule for words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for ASCII texts in lower case, where the standard library can split faster.
ASCII_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+"
WORD_END = "</w>"
# Entries of a process's memory of words; when it is full, the older half goes.
WORDS_KEPT = 300_000
LEXICON_WORDS = 524_288
# Words that one task compiles into an automaton.
SHARD_WORDS = 65_536
# Above every rank and id of a pair.
NEVER = 1 << 62


def normalise(text: str) -> str:
    """Composed characters in lower case, each lowered alone: a capital sigma does not look at its neighbours."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def splitter() -> Callable[[str], list[str]]:
    """Splits normalised texts into words."""
    any_words, ascii_words = regex.compile(WORD).findall, re.compile(ASCII_WORD).findall
    return lambda text: ascii_words(text) if text.isascii() else any_words(text)


class Merger:
    """Encodes single words by the vocabulary's merges, lowest rank first and leftmost among equals."""

    def __init__(self, path: str):
        self.vocab, merges, self.special = tokenizer.read_bpe(path)
        self.name = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.letter = {b: c for c, b in tokenizer.printable_bytes().items()}
        # The rank of a pair's merge, then the id that it gives in the low bits.
        self.rank = {
            (self.vocab[a], self.vocab[b]): rank << 24 | self.vocab[a + b] for rank, (a, b) in enumerate(merges)
        }

    def merge(self, word: bytes) -> list[int]:
        letters = [self.letter[b] for b in word]
        letters[-1] += WORD_END
        ids = [self.vocab[c] for c in letters]
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        get = self.rank.get
        ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            new = ids[i] = best & 0xFFFFFF
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((new, ids[i + 1]), NEVER)
            if i:
                ranks[i - 1] = get((ids[i - 1], new), NEVER)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same by a heap of neighbouring pairs, in n log n steps."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (found := self.rank.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (found >> 24, i, found & 0xFFFFFF, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


def build_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """The smallest acyclic automaton for distinct sorted words, numbering them in their order.

    States that accept the same endings are one. `key` holds state * 256 + byte of each
    arc in order, `target` where it leads, `skip` how many words of its state come before
    it; `final` tells whether a word ends in a state. A word's number is the sum of the
    skips on its way.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]  # the states of the last word

    def settle(down_to: int, word: bytes) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            signature = (final[state], tuple(arcs[state].items()))
            known = register.setdefault(signature, state)
            if known != state:
                arcs[path[-1]][word[len(path) - 1]] = known

    last = b""
    for word in words:
        shared = 0
        for x, y in zip(word, last):
            if x != y:
                break
            shared += 1
        settle(shared, last)
        for byte in word[shared:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][byte] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    settle(0, last)

    # Number the states that are left and count the words below each, leaves first.
    count: dict[int, int] = {}
    order: list[int] = []
    stack = [(0, False)]
    while stack:
        state, done = stack.pop()
        if done:
            count[state] = int(final[state]) + sum(count[t] for t in arcs[state].values())
            order.append(state)
        elif state not in count:
            count[state] = -1
            stack.append((state, True))
            stack += [(t, False) for t in arcs[state].values() if t not in count]
    number = {state: i for i, state in enumerate(reversed(order))}
    key, target, skip = [], [], []
    for state in reversed(order):
        passed = int(final[state])
        for byte, to in sorted(arcs[state].items()):
            key.append(number[state] << 8 | byte)
            target.append(number[to])
            skip.append(passed)
            passed += count[to]
    return {
        "key": np.array(key, np.int64),
        "target": np.array(target, np.int32),
        "skip": np.array(skip, np.int32),
        "final": np.array([final[s] for s in reversed(order)], np.bool_),
    }


PARTS = (("key", np.int64), ("target", np.int32), ("skip", np.int32), ("final", np.bool_), ("ids", np.int32), ("start", np.int64))


def pack_shard(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The automaton of distinct sorted words and their ids in one block: the sizes of the arrays of PARTS, then these."""
    arrays = build_automaton(words)
    arrays["ids"] = np.array([i for found in ids for i in found], np.int32)
    arrays["start"] = np.concatenate([[0], np.cumsum([len(found) for found in ids], dtype=np.int64)]).astype(np.int64)
    out = io.BytesIO()
    out.write(np.array([len(arrays[name]) for name, _ in PARTS], np.int64).tobytes())
    for name, kind in PARTS:
        out.write(arrays[name].astype(kind).tobytes())
        out.write(b"\0" * (-out.tell() % 8))
    return out.getvalue()


def pack_shards(shards: list[bytes]) -> bytes:
    """How many shards, the size of each, and then the shards."""
    return np.array([len(shards), *map(len, shards)], np.int64).tobytes() + b"".join(shards)


def shard_of(word: bytes, shards: int) -> int:
    return zlib.crc32(word) % shards


def pack_lexicon(words: list[str], merger: Merger, shards: int = 1) -> bytes:
    """A lexicon of words whose ids the merger gives."""
    coded = sorted({w.encode("utf-8", "surrogatepass") for w in words if w})
    dealt = [[w for w in coded if shard_of(w, shards) == k] for k in range(shards)]
    return pack_shards([pack_shard(own, [merger.merge(w) for w in own]) for own in dealt])


class Lexicon:
    """A packed lexicon, mapped into memory; processes of one machine share its pages."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, mode="r")
        count = int(data[:8].view(np.int64)[0])
        sizes = data[8 : 8 * (count + 1)].view(np.int64)
        ends = 8 * (count + 1) + np.cumsum(sizes)
        self.shards = [Shard(data[end - size : end]) for size, end in zip(sizes.tolist(), ends.tolist())]

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None where the lexicon lacks it."""
        if len(self.shards) < 2:
            return self.shards[0].find(words) if self.shards else [None] * len(words)
        dealt: list[list[int]] = [[] for _ in self.shards]
        for i, word in enumerate(words):
            dealt[shard_of(word, len(dealt))].append(i)
        out: list[list[int] | None] = [None] * len(words)
        for shard, own in zip(self.shards, dealt):
            for i, ids in zip(own, shard.find([words[i] for i in own])):
                out[i] = ids
        return out


class Shard:
    """The automaton of one part of the words."""

    def __init__(self, data: np.ndarray):
        sizes = data[: 8 * len(PARTS)].view(np.int64)
        at = 8 * len(PARTS)
        for (name, kind), size in zip(PARTS, sizes):
            nbytes = int(size) * np.dtype(kind).itemsize
            setattr(self, name, data[at : at + nbytes].view(kind))
            at += nbytes + -nbytes % 8

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None where the lexicon lacks it; all words walk the automaton side by side."""
        if not words or not len(self.key):
            return [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(sizes > 0)
        for step in range(int(sizes.max(initial=0))):
            alive = alive[sizes[alive] > step]
            if not len(alive):
                break
            wanted = state[alive] << 8 | flat[start[alive] + step]
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            hit = self.key[at] == wanted
            state[alive[~hit]] = -1
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
            number[alive] += self.skip[at]
        found = (state > 0) & self.final[np.maximum(state, 0)]
        ids, starts = self.ids, self.start
        return [ids[starts[n] : starts[n + 1]].tolist() if ok else None for ok, n in zip(found.tolist(), number.tolist())]


class Encoder:
    """Encodes texts word by word: memory, then the lexicon, then exact merges."""

    def __init__(self, vocabulary: str, lexicon: str):
        self.merger = Merger(vocabulary)
        self.lexicon = Lexicon(lexicon)
        self.split = splitter()
        special = sorted(self.merger.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.words: dict[str, tuple[int, str, str]] = {}

    def _learn(self, words: set[str]) -> None:
        listed = list(words)
        coded = [w.encode("utf-8", "surrogatepass") for w in listed]
        for word, code, ids in zip(listed, coded, self.lexicon.find(coded)):
            self._keep(word, self.merger.merge(code) if ids is None else ids)

    def _keep(self, word: str, ids: list[int]) -> None:
        name = self.merger.name
        self.words[word] = len(ids), " ".join(map(str, ids)), " ".join([name[i] for i in ids])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Per text: number of ids, decimal ids joined by spaces, and the decoded text."""
        split = []
        for text in texts:
            if self.marks and "<|" in text:
                words: list[str] = []
                for i, part in enumerate(self.marks.split(text)):
                    words += ["\0" + part] if i % 2 else self.split(normalise(part))
                split.append(words)
            else:
                split.append(self.split(normalise(text)))
        wanted = set().union(*split)
        if len(self.words) > WORDS_KEPT:
            for word in list(islice(self.words, len(self.words) // 2)):
                del self.words[word]
        wanted -= self.words.keys()
        marks = {w for w in wanted if w[0] == "\0" and w[1:] in self.merger.special}
        self._learn(wanted - marks)
        for mark in marks:
            self._keep(mark, [self.merger.special[mark[1:]]])
        known = self.words.__getitem__
        for words in split:
            if words:
                counts, ids, names = zip(*map(known, words))
                yield sum(counts), " ".join(ids), " ".join(names)
            else:
                yield 0, "", ""


@lru_cache(maxsize=2)
def encoder(vocabulary: str, lexicon_file: str) -> Encoder:
    return Encoder(vocabulary, SparkFiles.get(lexicon_file))


def frequent_words(docs: DataFrame, text_col: str = "text", limit: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent stretches without white space over all texts, in lower case, with their counts: `limit` at most.

    All rows are counted, first inside each task. Words are taken by how often they occur,
    in steps of a sixteenth of a doubling, as long as whole steps fit, so that no task has
    to send more than its share. The limit bounds the lexicon, not the result: words
    outside it are merged.
    """
    word = F.explode(F.split(F.lower(F.col(text_col)), r"\s+"))
    counts = docs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    step = F.floor(16 * F.log2("n")).cast("int")
    counts, _ = materialize(counts.filter((F.col("n") > 1) & (F.length("word").between(1, 64))).withColumn("step", step))
    least, total = 1 << 30, 0
    # At most 16 steps a doubling of the largest count.
    for row in counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        total += row["words"]
        if total > limit:
            break
        least = row["step"]
    return counts.filter(F.col("step") >= least).select("word", "n")


def ship_lexicon(spark: SparkSession, packed: bytes) -> str:
    """Have Spark hand the block to every executor; returns its name there."""
    name = f"lexicon-{hashlib.sha256(packed).hexdigest()[:24]}"
    if not is_shared(spark, name):
        spark.sparkContext.addFile(write_shared(spark, name, packed))
    return name


def make_lexicon(
    docs: DataFrame,
    text_col: str = "text",
    vocabulary: str = tokenizer.WORD_BPE,
    limit: int = LEXICON_WORDS,
    shard_words: int = SHARD_WORDS,
) -> str:
    """Compile the frequent words of `docs` into a lexicon file on every executor; returns its name.

    Tasks over the table of counts split and merge each word once, and one task a shard
    compiles its automaton. The driver joins the shards, of about 40 bytes a word and at most
    `limit` stretches in all.
    """
    shards = -(-limit // shard_words)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, split = Merger(vocabulary), splitter()
        for batch in batches:
            words = {w for text in batch.column(0).to_pylist() for w in split(normalise(text))}
            coded = [w.encode("utf-8", "surrogatepass") for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard_of(w, shards) for w in coded], pa.int32()),
                    pa.array(coded, pa.binary()),
                    pa.array([np.array(merger.merge(w), np.int32).tobytes() for w in coded], pa.binary()),
                ],
                names=["shard", "word", "ids"],
            )

    def compiled(key, table):
        found = dict(zip(table.column("word").to_pylist(), table.column("ids").to_pylist()))
        words = sorted(found)
        packed = pack_shard(words, [np.frombuffer(found[w], np.int32).tolist() for w in words])
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([packed], pa.binary())], ["shard", "packed"])

    words = frequent_words(docs, text_col, limit).select("word").mapInArrow(merged, "shard int, word binary, ids binary")
    found = {r["shard"]: r["packed"] for r in words.groupBy("shard").applyInArrow(compiled, "shard int, packed binary").collect()}
    empty = pack_shard([], [])
    return ship_lexicon(docs.sparkSession, pack_shards([bytes(found.get(k, empty)) for k in range(shards)]))


SCHEMA = "doc_id long, n_tokens long, ids {ids}, decoded string, ids_sha256 string, decoded_sha256 string"


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = tokenizer.WORD_BPE,
    limit: int = LEXICON_WORDS,
    digests_only: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, the ids, the text decoded from them, and digests of both.

    The result is the vocabulary library's own, special strings in texts included. The
    words counted over all of `docs` that are most frequent become a lexicon of at most
    `limit` stretches; each task looks its words up there and merges those it lacks.
    With `digests_only`, ids and decoded are null. A null or empty text has no ids. Rows
    with null or repeated ids each give a row; other columns are ignored. Only word counts
    are shuffled.
    """
    lexicon = make_lexicon(docs, text_col, vocabulary, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, lexicon)
        for batch in batches:
            counts, ids, decoded, ids_digest, decoded_digest = [], [], [], [], []
            for block in blocks([t or "" for t in batch.column(1).to_pylist()]):
                for n, id_text, text in coder.encode(block):
                    counts.append(n)
                    ids_digest.append(hashlib.sha256(id_text.encode()).hexdigest())
                    decoded_digest.append(hashlib.sha256(text.encode()).hexdigest())
                    ids.append(None if digests_only else np.array(id_text.split(), np.int32))
                    decoded.append(None if digests_only else text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(decoded, pa.string()),
                    pa.array(ids_digest, pa.string()),
                    pa.array(decoded_digest, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA.format(ids="array<int>"))


def encode_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return encode(docs, digests_only=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
