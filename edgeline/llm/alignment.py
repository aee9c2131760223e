"""Cross-tokenizer alignment: which tokens of two vocabularies overlap, and in how many documents each pair does."""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.llm import tokenizer
from edgeline.runtime import broadcast_if_small, materialize

PIECES = public_tokenizers.path("piece_bpe_32k.model")
# A block of documents, whose records are sorted together, has about this many characters.
BLOCK_CHARS = 2_000_000
# Documents in a block at most; their numbers inside it have 16 bits.
BLOCK_DOCS = 60_000
DOC_BITS = 16
# Ids of the first vocabulary are dealt over this many radix partitions.
RADIX = 64
# Records that one task merges; a radix partition with more is split by blocks of documents.
TASK_RECORDS = 8_000_000
# Entries that a run being merged hands on at once.
CHUNK = 4096

RUN_COLUMNS = "block long, radix int, n_docs int, records long, pairs binary, docs binary"
DOC_COLUMNS = "doc_id long, at int, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string"


class Sides:
    """Both vocabularies: encoders, the bytes of every id, and the pieces of a written alignment."""

    def __init__(self, ranks: str, pieces: str):
        import sentencepiece

        self.a = tokenizer.rank_encoder(ranks)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (self.a.max_token_value + 1)
        for token in range(len(self.a_bytes)):
            try:
                self.a_bytes[token] = self.a.decode_single_token_bytes(token)
            except KeyError:
                continue
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_len = np.array(list(map(len, self.b_bytes)), np.int64)
        self.written = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"]
        self.written += [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where a side's bytes are not those of a space and the text."""
        none = np.zeros(0, np.int64)
        ids_a, ids_b = [], []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            spaced = " " + text
            data = spaced.encode("utf-8", "surrogatepass")
            a = self.a.encode_ordinary(spaced) if text else []
            same = text and b"".join(map(self.b_bytes.__getitem__, b)) == data == b"".join(map(self.a_bytes.__getitem__, a))
            ids_a.append(np.array(a, np.int64) if same else none)
            ids_b.append(np.array(b, np.int64) if same else none)
        return ids_a, ids_b


@lru_cache(maxsize=2)
def sides(ranks: str, pieces: str) -> Sides:
    return Sides(ranks, pieces)


class Keys:
    """A number for each pair of ids that orders them by radix partition, then first id, then second id."""

    def __init__(self, n_a: int, n_b: int, radix: int):
        self.n_b, self.radix = n_b, radix
        self.ids = -(-n_a // radix)
        self.span = self.ids * n_b
        if self.span >= 1 << 32 or self.span * radix >= 1 << (63 - DOC_BITS):
            raise ValueError("the vocabularies have too many pairs of ids")

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a % self.radix) * self.ids + a // self.radix) * self.n_b + b


class Block:
    """The alignment of a block of documents, laid end to end so that every step is one pass over arrays."""

    def __init__(self, both: Sides, texts: list[str], keys: Keys):
        ids_a, ids_b = both.encode(texts)
        self.both, self.keys = both, keys
        self.n_a, self.n_b = (np.array(list(map(len, x)), np.int64) for x in (ids_a, ids_b))
        self.a, self.b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(both.a_len[self.a]), np.cumsum(both.b_len[self.b])
        size = int(ends_a[-1]) if len(ends_a) else 0
        in_a, in_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        in_a[ends_a], in_b[ends_b] = True, True
        # Between two neighbouring ends of any side lies the overlap of exactly one pair.
        stops = np.flatnonzero(in_a | in_b)
        self.stop_a, self.stop_b = in_a[stops], in_b[stops]
        self.last_a, self.last_b = in_b[ends_a], in_a[ends_b]
        both_stop = self.stop_a & self.stop_b
        self.group = np.cumsum(both_stop) - both_stop
        # The number of segments and of groups up to the end of each document's last token.
        upto = np.zeros(len(texts) + 1, np.int64)
        upto[1:] = np.searchsorted(stops, np.concatenate([[0], ends_a])[np.cumsum(self.n_a)], "right")
        done = np.concatenate([[0], np.cumsum(both_stop)])
        self.n_links, self.n_groups = np.diff(upto), np.diff(done[upto])

    def written(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each document: the ids of each group, first side first."""
        group_a, group_b = self.group[self.stop_a], self.group[self.stop_b]
        n = int(self.group[-1]) + 1 if len(self.group) else 0
        per_a, per_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        if n:
            codes[np.arange(len(self.a)) + np.concatenate([[0], per_b])[group_a]] = self.a * 2 + self.last_a
            codes[np.arange(len(self.b)) + per_a[group_b]] = 2 * len(self.both.a_bytes) + self.b * 2 + self.last_b
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        name = self.both.written.__getitem__
        return ["".join(map(name, codes[start:end].tolist()))[:-1] for start, end in zip([0, *ends], ends)]

    def runs(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(radix, records, pairs, docs) for each radix partition; records are sorted by pair, then document."""
        at_a, at_b = np.cumsum(self.stop_a) - self.stop_a, np.cumsum(self.stop_b) - self.stop_b
        doc = np.repeat(np.arange(len(self.n_links)), self.n_links)
        records = self.keys.of(self.a[at_a], self.b[at_b]) << DOC_BITS | doc
        records, links = np.unique(records, return_counts=True)
        pair, doc = records >> DOC_BITS, (records & ((1 << DOC_BITS) - 1)).astype(np.uint16)
        firsts = np.flatnonzero(np.diff(pair, prepend=-1))
        distinct, n_docs = pair[firsts], np.diff(firsts, append=len(pair))
        borders = np.arange(self.keys.radix + 1) * self.keys.span
        cuts, pair_cuts = np.searchsorted(pair, borders), np.searchsorted(distinct, borders)
        zstd = zstandard.ZstdCompressor(level=1)
        for radix in np.flatnonzero(np.diff(cuts)).tolist():
            mine, own = slice(cuts[radix], cuts[radix + 1]), slice(pair_cuts[radix], pair_cuts[radix + 1])
            steps = np.diff(distinct[own] - borders[radix], prepend=0)
            yield (
                radix,
                int(cuts[radix + 1] - cuts[radix]),
                zstd.compress(np.concatenate([steps, n_docs[own]]).astype(np.uint32).tobytes()),
                zstd.compress(doc[mine].tobytes() + links[mine].astype(np.uint32).tobytes()),
            )


def read_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a run, counted from its radix partition's first, and how many of its documents have each."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint32).astype(np.int64)
    half = len(data) // 2
    return np.cumsum(data[:half]), data[half:]


def read_docs(blob: bytes, records: int) -> tuple[np.ndarray, np.ndarray]:
    """For each record of a run its document's number in the block and its links."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(data, np.uint16, records), np.frombuffer(data, np.uint32, records, 2 * records).astype(np.int64)


def merge_runs(blobs: list[bytes]) -> tuple[array, array]:
    """Distinct pairs in order with their counts over all runs, by a heap of the runs' next entries."""

    def stream(blob: bytes) -> Iterator[tuple[int, int]]:
        pairs, counts = read_pairs(blob)
        for at in range(0, len(pairs), CHUNK):
            yield from zip(pairs[at : at + CHUNK].tolist(), counts[at : at + CHUNK].tolist())

    merged, totals = array("q"), array("q")
    last, total = -1, 0
    for pair, count in heapq.merge(*map(stream, blobs)):
        if pair != last:
            if total:
                merged.append(last)
                totals.append(total)
            last, total = pair, 0
        total += count
    if total:
        merged.append(last)
        totals.append(total)
    return merged, totals


def doc_blocks(texts: list[str], chars: int) -> Iterator[slice]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars or i + 1 - start >= BLOCK_DOCS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class Alignment:
    """Documents aligned and their pairs counted; each step is a table in the checkpoint folder.

    Tasks over documents write, beside a row for each document, sorted zstd runs of (pair,
    document, links) records for each radix partition of the first side's ids. Tasks over
    radix partitions merge runs with a heap; a partition of over `task_records` records,
    such as that of a very frequent token, is split by blocks of documents and its partial
    counts are added up. The table of counts has a row for each pair of ids that occurs, so
    the vocabularies bound it, whatever the number of documents.
    """

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        ranks: str = tokenizer.BYTE_BPE_RANKS,
        pieces: str = PIECES,
        radix: int = RADIX,
        task_records: int = TASK_RECORDS,
        block_chars: int = BLOCK_CHARS,
        with_groups: bool = False,
    ):
        both = sides(ranks, pieces)
        self.keys = keys = Keys(len(both.a_bytes), len(both.b_bytes), radix)
        schema = f"{DOC_COLUMNS}, {RUN_COLUMNS}"

        def block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabularies = sides(ranks, pieces)
            block = TaskContext.get().partitionId() << 32
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = batch.column(0)
                for part in doc_blocks(texts, block_chars):
                    aligned = Block(vocabularies, texts[part], keys)
                    yield doc_rows(aligned, ids.slice(part.start, part.stop - part.start), block, with_groups)
                    yield run_rows(aligned, block)
                    block += 1

        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        written, _ = materialize(rows.mapInArrow(block_batches, schema))
        self.docs = written.filter("radix IS NULL").select("block", *(c.split()[0] for c in DOC_COLUMNS.split(", ")))
        runs = written.filter("radix IS NOT NULL").select(*(c.split()[0] for c in RUN_COLUMNS.split(", ")))
        # One row per radix partition.
        sizes = runs.groupBy("radix").agg(F.ceil(F.sum("records") / F.lit(task_records)).cast("int").alias("splits"))
        self.splits, _ = materialize(sizes)
        split = F.pmod(F.xxhash64("block"), F.col("splits")).cast("int")
        self.runs = runs.join(F.broadcast(self.splits), "radix").withColumn("split", split).drop("splits")
        self.counts = self._counted()

    def _counted(self) -> DataFrame:
        """(radix, pair, n): how many documents link the pair, counted from its radix partition's first."""

        def merged(key, table):
            pairs, counts = merge_runs(table.column("pairs").to_pylist())
            radix = pa.array(np.full(len(pairs), key[0].as_py(), np.int32))
            return pa.table([radix, pa.array(np.array(pairs, np.int64)), pa.array(np.array(counts, np.int64))], ["radix", "pair", "n"])

        parts = self.runs.select("radix", "split", "pairs").groupBy("radix", "split").applyInArrow(merged, "radix int, pair long, n long")
        counts, _ = materialize(parts.groupBy("radix", "pair").agg(F.sum("n").alias("n")))
        return counts

    def pair_counts(self) -> DataFrame:
        """(a_id, b_id, n_docs, is_best): every linked pair, and whether none of its first id's is more frequent."""
        keys = self.keys
        local = F.floor(F.col("pair") / F.lit(keys.n_b))
        ids = self.counts.select(
            (local * keys.radix + F.col("radix")).alias("a_id"),
            F.pmod("pair", F.lit(keys.n_b)).alias("b_id"),
            F.col("n").alias("n_docs"),
        )
        best, seen = materialize(ids.groupBy("a_id").agg(F.max("n_docs").alias("most")))
        joined = ids.join(broadcast_if_small(best, seen["bytes"]), "a_id")
        return joined.select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))

    def contributions(self) -> DataFrame:
        """(block, sums): per run, what its pairs' counts add to n_best and count_sum of each of its block's documents."""
        n_b = self.keys.n_b

        def added(key, counts, runs):
            order = np.argsort(counts.column("pair").to_numpy())
            pairs, n = counts.column("pair").to_numpy()[order], counts.column("n").to_numpy()[order]
            # In this order a first id's pairs stand together.
            firsts = np.flatnonzero(np.diff(pairs // n_b, prepend=-1))
            most = np.maximum.reduceat(n, firsts) if len(firsts) else n
            best = n == np.repeat(most, np.diff(firsts, append=len(pairs)))
            zstd, sums = zstandard.ZstdCompressor(level=1), []
            blocks = runs.column("block").to_pylist()
            for i in range(runs.num_rows):
                own, n_docs = read_pairs(runs.column("pairs")[i].as_py())
                doc, links = read_docs(runs.column("docs")[i].as_py(), runs.column("records")[i].as_py())
                at = np.searchsorted(pairs, own)
                total = np.zeros((2, runs.column("n_docs")[i].as_py()), np.int64)
                np.add.at(total[0], doc, links * np.repeat(best[at], n_docs))
                np.add.at(total[1], doc, links * np.repeat(n[at], n_docs))
                sums.append(zstd.compress(total.tobytes()))
            return pa.table([pa.array(blocks, pa.int64()), pa.array(sums, pa.binary())], ["block", "sums"])

        copies = F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split")
        counts = self.counts.join(F.broadcast(self.splits), "radix").select("radix", copies, "pair", "n")
        grouped = counts.groupBy("radix", "split").cogroup(self.runs.groupBy("radix", "split"))
        return grouped.applyInArrow(added, "block long, sums binary")

    def per_document(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256."""
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256"]

        def summed(key, docs, parts):
            total = np.zeros((2, docs.num_rows), np.int64)
            for sums in parts.column("sums").to_pylist():
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(sums), np.int64).reshape(total.shape)
            total = total[:, docs.column("at").to_numpy()]
            out = docs.select(names)
            return out.append_column("n_best", pa.array(total[0])).append_column("count_sum", pa.array(total[1]))

        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, n_best long, count_sum long"
        parts, _ = materialize(self.contributions())
        joined = self.docs.groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(summed, schema)
        return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256")


def doc_rows(block: Block, ids: pa.Array, number: int, with_groups: bool) -> pa.RecordBatch:
    n = len(ids)
    written = block.written()
    digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
    columns = [
        ids, pa.array(np.arange(n, dtype=np.int32)), pa.array(block.n_a), pa.array(block.n_b), pa.array(block.n_groups),
        pa.array(block.n_links), pa.array(written if with_groups else [None] * n, pa.string()), pa.array(digests, pa.string()),
        pa.array(np.full(n, number, np.int64)), *(pa.nulls(n, kind) for kind in (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in f"{DOC_COLUMNS}, {RUN_COLUMNS}".split(", ")])


def run_rows(block: Block, number: int) -> pa.RecordBatch:
    runs = list(block.runs()) if len(block.a) else []
    n = len(runs)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    columns = [
        *(pa.nulls(n, kind) for kind in kinds), pa.array([number] * n, pa.int64()), pa.array([r[0] for r in runs], pa.int32()),
        pa.array([len(block.n_a)] * n, pa.int32()), pa.array([r[1] for r in runs], pa.int64()),
        pa.array([r[2] for r in runs], pa.binary()), pa.array([r[3] for r in runs], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in f"{DOC_COLUMNS}, {RUN_COLUMNS}".split(", ")])


def align_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query: one row per row of `docs`, whatever its id.

    Null and empty texts, and those that a vocabulary does not give back byte by byte, have
    no tokens: zeros and an empty digest. Other columns are ignored.
    """
    return Alignment(docs).per_document().drop("groups")
