"""Near-duplicates by chosen paths: documents branch by selected minwise tokens, small nodes are compared whole."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.llm.components import min_labels
from edgeline.runtime import BROADCAST_BYTES, broadcast_if_small, lookup, materialize

SLOTS = 128
# A sketch has two bits of each slot, so of a pair at 0.8 each agrees with a chance of 0.85;
# under 89 of 128 do so in about three of a million such pairs, which are not looked at further.
LEAST_AGREEING = 89
# From here on a pair is almost surely a link, so it is confirmed first.
LIKELY_AGREEING = 117
TREES = 14
SMALL_NODE = 3000
LEVELS = 12
# Pairs of a node that are turned into Python numbers at once.
PAIRS_AT_ONCE = 50_000
# Elements of a cluster's sets that are counted at once.
ELEMENTS_AT_ONCE = 1_000_000

_seeds = np.random.default_rng(20240229)
_scale = _seeds.integers(1 << 62, 1 << 63, SLOTS, dtype=np.uint64) | np.uint64(1)
_shift = _seeds.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles of `size` words, A-Z lowered.

    Words are what stands between ASCII white space. A text with fewer words is one
    shingle; one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    size = min(size, len(words))
    whole = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        whole = mix(whole * _ODD + hashes[k : len(words) - size + 1 + k])
    return np.unique(whole)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of SLOTS hash functions."""
    best = np.full(SLOTS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 2048):
        hashed = (shingles[at : at + 2048, None] * _scale + _shift) >> np.uint64(32)
        np.minimum(best, hashed.min(axis=0), out=best)
    return best.astype(np.uint32)


def sketched(slots: np.ndarray) -> bytes:
    """The lowest two bits of each slot."""
    bits = (slots & np.uint32(3)).astype(np.uint64).reshape(-1, 32) << (2 * np.arange(32, dtype=np.uint64))
    return np.bitwise_or.reduce(bits, axis=1).tobytes()


def same_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many slots agree, of rows of sketches read as SLOTS / 32 numbers of 64 bits."""
    differ = a ^ b
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return SLOTS - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def row_keys(id_col: str, text_col: str) -> dict[str, Column]:
    """Two hashes, equal for rows of the same id and text."""
    doc, text = F.col(id_col).cast("long"), F.col(text_col)
    return {"k1": F.xxhash64(doc, text), "k2": F.xxhash64(F.lit(1), doc, text)}


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, k1, k2, n_shingles, set_key (16 bytes, equal for equal sets; null for empty ones), slots (SLOTS 4-byte
    tokens) and their sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, slots, sketches = [], [], [], []
            for text in batch.column(3).to_pylist():
                shingles = shingle_set(text, size)
                sizes.append(len(shingles))
                best = minwise(shingles) if len(shingles) else None
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                slots.append(best.tobytes() if len(shingles) else None)
                sketches.append(sketched(best) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), *(pa.array(c, pa.binary()) for c in (keys, slots, sketches))],
                names=["doc_id", "k1", "k2", "n_shingles", "set_key", "slots", "sketch"],
            )

    keys = row_keys(id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(c.alias(n) for n, c in keys.items()), F.col(text_col).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, k1 long, k2 long, n_shingles long, set_key binary, slots binary, sketch binary")


def branch(rows: DataFrame, threshold: float, roots: int = 0, first: int = 0) -> DataFrame:
    """(node, rep): each document goes on into the nodes of its chosen tokens, 1 / threshold of them on average.

    Rows have rep and slots, and with `roots` = 0 the node they branch from; else each
    starts in as many roots, numbered from `first` on. A token is chosen by a hash of the node it branches from, so
    all documents of a node that have the token choose alike.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance = np.uint64(int(2**64 / (threshold * SLOTS)))
        place = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * _ODD)
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            slots = np.frombuffer(b"".join(batch.column("slots").to_pylist()), np.uint32).reshape(-1, SLOTS)
            tokens = mix(slots.astype(np.uint64) + place)
            if roots:
                parents = [np.full(len(reps), r + 1, np.uint64) for r in range(first, first + roots)]
            else:
                parents = [batch.column("node").to_numpy().view(np.uint64)]
            for parent in parents:
                paths = mix(tokens ^ mix(parent * _ODD)[:, None])
                row, slot = np.nonzero(paths < chance)
                nodes = mix(paths[row, slot] + _ODD).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(reps[row])], names=["node", "rep"])

    return rows.mapInArrow(choose, "node long, rep long")


def grows(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input, so that it is never broadcast, however small it is here."""
    return side.hint("merge")


def sized(members: DataFrame) -> DataFrame:
    """Nodes with two members or more: (node, rep, members)."""
    counts = members.groupBy("node").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return members.join(grows(counts), "node")


def trees_for(levels: int, miss: float = 0.001) -> int:
    """Trees that together miss a pair at the threshold with at most the chance `miss`, where nodes have `levels` levels.

    One tree takes such a pair down a further level with one shared node on average, so its
    chance to meet is 0.63 after one level, 0.47 after two and 0.14 after twelve.
    """
    chance = 1.0
    for _ in range(levels):
        chance = 1 - math.exp(-chance)
    return math.ceil(math.log(miss) / math.log1p(-chance))


def small_nodes(slots: DataFrame, threshold: float, roots: int, first: int = 0) -> tuple[DataFrame, DataFrame | None, int]:
    """(node, rep, members) of the nodes that `roots` trees end in, those still large, and the number of levels.

    `slots` has rep and slots of every set.
    Nodes above SMALL_NODE members branch further; after LEVELS levels, for which their
    members share as many random minwise tokens, they are given back as large ones.
    """
    members, seen = materialize(
        sized(branch(slots, threshold, roots, first)),
        large=F.count_if(F.col("members") > SMALL_NODE),
    )
    small = members.filter(F.col("members") <= SMALL_NODE)
    level = 1
    while seen["large"]:
        large = members.filter(F.col("members") > SMALL_NODE)
        if level == LEVELS:
            return small, large, level
        # Only the members of large nodes take their slots along.
        wanted, size = materialize(large.select("rep").distinct())
        theirs = slots.join(broadcast_if_small(wanted, size["bytes"]), "rep", "left_semi")
        rows = large.select("node", "rep").join(grows(theirs), "rep")
        members, seen = materialize(
            sized(branch(rows, threshold)), large=F.count_if(F.col("members") > SMALL_NODE)
        )
        small = small.unionByName(members.filter(F.col("members") <= SMALL_NODE))
        level += 1
    return small, None, level


def around_hubs(large: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of a large node's smallest member with every other one that its sketch agrees with."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            one, two = (read_sketches(table[c]) for c in ("sketch", "hub_sketch"))
            sizes, others = table["size"].to_numpy(), table["hub_size"].to_numpy()
            near = (same_slots(one, two) >= LEAST_AGREEING) & (np.minimum(sizes, others) >= threshold * np.maximum(sizes, others) - 1e-9)
            found = table.filter(pa.array(near)).select(["hub", "rep"]).rename_columns(["a", "b"])
            yield from found.to_batches()

    hubs, seen = materialize(large.groupBy("node").agg(F.min(F.struct("rep", "size", "sketch")).alias("first")))
    named = hubs.select(
        "node", F.col("first.rep").alias("hub"), F.col("first.size").alias("hub_size"), F.col("first.sketch").alias("hub_sketch")
    )
    if seen["bytes"] <= BROADCAST_BYTES:
        met = large.join(F.broadcast(named), "node")
    else:
        met = lookup(large, "node", named, F.col("rep"))
    return met.filter("rep <> hub").mapInArrow(agree, "a long, b long")


def in_blocks(large: DataFrame) -> DataFrame:
    """(node, rep, label, size, sketch): nodes in which each member outside a large node's main component meets all.

    `large` has labels. Members of the component that holds most of a node are connected
    already, so they only meet the rest, in blocks of half of SMALL_NODE of either.
    """
    half = max(SMALL_NODE // 2, 1)
    per_label = large.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    per_node = per_label.groupBy("node").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"),
        F.ceil(F.sum("n") / half).cast("int").alias("blocks"),
        F.ceil((F.sum("n") - F.max("n")) / half).cast("int").alias("rests"),
    )
    open_nodes, seen = materialize(per_node.filter("rests > 0"))
    if seen["bytes"] <= BROADCAST_BYTES:
        rows = large.join(F.broadcast(open_nodes), "node")
    else:
        rows = lookup(large, "node", open_nodes, F.col("rep"), how="inner")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    rows = rows.withColumn("rest", F.when(F.col("label") != F.col("main"), F.pmod(F.xxhash64("rep"), "rests").cast("int")))
    node = F.xxhash64("node", "block", "met")
    everyone = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)))
    others = rows.filter("rest IS NOT NULL").withColumn("met", F.col("rest")).withColumn("own", F.col("block"))
    others = others.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter(F.col("block") != F.col("own"))
    columns = [node.alias("node"), "rep", "label", "size", "sketch"]
    return everyone.select(*columns).unionByName(others.select(*columns))


def agreeing(sketches: np.ndarray, sizes: np.ndarray, labels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs i < j of one node with different labels that may be links, with the number of agreeing slots.

    A node may have millions of them, so they are held in the smallest numbers that do.
    """
    place = np.min_scalar_type(len(sketches))
    left, right, score = [], [], []
    for i in range(len(sketches) - 1):
        low, high = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
        same = same_slots(sketches[i + 1 :], sketches[i])
        near = np.flatnonzero((same >= LEAST_AGREEING) & (low >= threshold * high - 1e-9) & (labels[i + 1 :] != labels[i]))
        left.append(np.full(len(near), i, place))
        right.append((near + i + 1).astype(place))
        score.append(same[near].astype(np.uint8))
    return np.concatenate(left), np.concatenate(right), np.concatenate(score)


def ends_among(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Which of n members are in a pair, in order."""
    taken = np.zeros(n, bool)
    taken[left] = taken[right] = True
    return np.flatnonzero(taken)


def likely_first(score: np.ndarray) -> Iterator[np.ndarray]:
    """Places of all pairs: likely links, then the others, those that agree more first."""
    yield np.flatnonzero(score >= LIKELY_AGREEING)
    for least in np.flatnonzero(np.bincount(score, minlength=LIKELY_AGREEING)[:LIKELY_AGREEING])[::-1]:
        yield np.flatnonzero(score == least)


def tree_of(labels: np.ndarray, left: np.ndarray, right: np.ndarray, score: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what all given pairs connect, likely links first and around few members.

    Members of the same label are connected from the start.
    """
    _, first = np.unique(labels, return_inverse=True)
    parent = list(range(int(first.max(initial=-1)) + 1))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for some in (order[at : at + PAIRS_AT_ONCE] for order in likely_first(score) for at in range(0, len(order), PAIRS_AT_ONCE)):
        i, j = left[some], right[some]
        for i, j, x, y in zip(i.tolist(), j.tolist(), first[i].tolist(), first[j].tolist()):
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                kept.append((i, j))
                if len(kept) == len(parent) - 1:
                    return kept
    return kept


def by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int], list[int]]]:
    """Tables of whole nodes out of rows that come sorted by node, with the first row and the end of each node."""
    held: pa.Table | None = None

    def bounded(table: pa.Table) -> tuple[pa.Table, list[int], list[int]]:
        node = table["node"].to_numpy()
        cuts = (np.flatnonzero(node[1:] != node[:-1]) + 1).tolist()
        return table, [0, *cuts], [*cuts, len(node)]

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        node = table["node"].to_numpy()
        last = int(np.flatnonzero(node != node[-1])[-1]) + 1 if node[0] != node[-1] else 0
        held = table.slice(last)  # the last node may go on in the next batch
        if last:
            yield bounded(table.slice(0, last))
    if held is not None:
        yield bounded(held)


def read_sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SLOTS // 32)


def columns_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return *(table[c].to_numpy() for c in ("rep", "label", "size")), read_sketches(table["sketch"])


def dealt_by_node(leaves: DataFrame, *columns: str) -> DataFrame:
    return leaves.select("node", *columns).repartition("node").sortWithinPartitions("node")


LEAF = ("rep", "label", "size", "sketch")


def candidates(leaves: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that connect what the candidates of each node connect; and, with b null, members to look at again.

    `leaves` has node, rep, label, size and sketch, at most SMALL_NODE rows a node. Every
    pair of a node with different labels is compared by its sketches. Where a node has more
    candidates than the pairs that connect them, its members come with node, a, size and
    sketch.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends in by_node(batches):
            reps, labels, sizes, sketches = columns_of(table)
            out: set[tuple[int, int]] = set()
            # Nodes of two are the bulk; they are compared together.
            two = np.array([s for s, e in zip(starts, ends) if e - s == 2], np.int64)
            low, high = np.minimum(sizes[two], sizes[two + 1]), np.maximum(sizes[two], sizes[two + 1])
            two = two[
                (same_slots(sketches[two], sketches[two + 1]) >= LEAST_AGREEING)
                & (low >= threshold * high - 1e-9)
                & (labels[two] != labels[two + 1])
            ]
            low, high = np.minimum(reps[two], reps[two + 1]), np.maximum(reps[two], reps[two + 1])
            out.update(zip(low.tolist(), high.tolist()))
            again: list[np.ndarray] = [np.zeros(0, np.int64)]
            for start, end in zip(starts, ends):
                if end - start > 2 and (labels[start:end] != labels[start]).any():
                    # In order of rep, so that different nodes choose the same pairs.
                    order = start + np.argsort(reps[start:end], kind="stable")
                    left, right, score = agreeing(sketches[order], sizes[order], labels[order], threshold)
                    if len(left):
                        own = reps[order].tolist()
                        tree = tree_of(labels[order], left, right, score)
                        out.update((own[i], own[j]) for i, j in tree if own[i] != own[j])
                        if len(tree) < len(left):
                            again.append(order[ends_among(left, right, end - start)])
            pairs, rows = list(out), np.concatenate(again)
            left, right = [a for a, _ in pairs], [b for _, b in pairs]
            n = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                names=["node", "a", "b", "size", "sketch"],
            )
            kept = table.take(pa.array(rows)).combine_chunks()
            kept = kept.select(["node", "rep", "size", "sketch"]).rename_columns(["node", "a", "size", "sketch"])
            kept = kept.add_column(2, "b", pa.nulls(len(rows), pa.int64()))
            yield from kept.to_batches()

    return dealt_by_node(leaves, *LEAF).mapInArrow(compare, "node long, a long, b long, size long, sketch binary")


def unsettled(leaves: DataFrame, threshold: float) -> DataFrame:
    """The rows of `leaves` that still have a candidate with another label in their node, with its number there.

    Rows of a node that candidates connect share a `cluster`.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends in by_node(batches):
            reps, labels, sizes, sketches = columns_of(table)
            keep, clusters = [], []
            for start, end in zip(starts, ends):
                part = slice(start, end)
                if (labels[part] == labels[start]).all():
                    continue
                left, right, score = agreeing(sketches[part], sizes[part], labels[part], threshold)
                parent = {i: i for i in ends_among(left, right, end - start).tolist()}
                for i, j in tree_of(np.arange(end - start), left, right, score):
                    while parent[i] != i:
                        i = parent[i]
                    while parent[j] != j:
                        j = parent[j]
                    parent[max(i, j)] = min(i, j)
                for i in sorted(parent):
                    top = i
                    while parent[top] != top:
                        top = parent[top]
                    keep.append(start + i)
                    clusters.append(top)
            chosen = table.take(pa.array(keep, pa.int64())).select(["node", "rep", "label"])
            chosen = chosen.append_column("cluster", pa.array(clusters, pa.int32())).combine_chunks()
            yield from chosen.to_batches()

    return dealt_by_node(leaves, *LEAF).mapInArrow(compare, "node long, rep long, label long, cluster int")


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sorted sets of hashes.

    They come from products of 0/1 matrices over the elements that at least two of the
    sets have, taken a range of hashes at a time, so that memory does not grow with the sets.
    """
    n = len(sets)
    both = np.zeros((n, n), np.float32)
    ranges = math.ceil(sum(map(len, sets)) / ELEMENTS_AT_ONCE)
    cuts = np.array([(1 << 64) * k // ranges for k in range(1, ranges)], np.uint64)
    places = [[0, *np.searchsorted(s, cuts).tolist(), len(s)] for s in sets]
    for k in range(ranges):
        parts = [s[p[k] : p[k + 1]] for s, p in zip(sets, places)]
        _, element, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(n), [len(p) for p in parts])
        shared = count >= 2
        column = np.cumsum(shared) - 1
        row, element = row[shared[element]], column[element[shared[element]]]
        order = np.argsort(element, kind="stable")
        row, element = row[order], element[order]
        total = int(shared.sum())
        for at in range(0, total, 2048):
            part = slice(*np.searchsorted(element, [at, at + 2048]))
            block = np.zeros((n, min(2048, total - at)), np.float32)
            block[row[part], element[part] - at] = 1
            both += block @ block.T
    return both


def links_among(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of sets that reach the threshold and connect different labels: one for each two labels that they join."""
    sizes, both = np.array([len(s) for s in sets]), shared_sizes(sets)
    found, parent = [], {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    for i in range(len(sets) - 1):
        same, other = both[i, i + 1 :], labels[i + 1 :] != labels[i]
        linked = 100 * same >= percent * (sizes[i] + sizes[i + 1 :] - same) - 1e-3
        for j in (np.flatnonzero(linked & other) + i + 1).tolist():
            a, b = root(int(labels[i])), root(int(labels[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((i, j))
    return found


def remaining_links(rows: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links (a, b) between different labels inside the clusters of `unsettled` rows, by whole sets.

    Each cluster meets in one task, at most SMALL_NODE sets; only links come out.
    """
    percent = round(100 * threshold)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, ends in by_node(batches):
            reps, labels, clusters = (table[c].to_numpy() for c in ("rep", "label", "cluster"))
            out = []
            for start, end in zip(starts, ends):
                for cluster in np.unique(clusters[start:end]):
                    some = start + np.flatnonzero(clusters[start:end] == cluster)
                    sets = [np.frombuffer(table["shingles"][int(i)].as_buffer(), np.uint64) for i in some]
                    out += [(int(reps[some[i]]), int(reps[some[j]])) for i, j in links_among(sets, labels[some], percent)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"]
            )

    wanted = rows.select(F.col("rep").alias("id")).distinct()
    sets, _ = materialize(texts.join(grows(wanted), "id", "left_semi").mapInArrow(shingled, "rep long, shingles binary"))
    dealt = dealt_by_node(rows.join(grows(sets), "rep"), "rep", "label", "cluster", "shingles")
    return dealt.mapInArrow(link, "a long, b long").distinct()


def texts_of(ids: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of the sets whose rep is in `ids` (column id), written once; the text is that of the row a set is named by."""
    wanted = sets.select(F.col("rep").alias("id"), "k1", "k2").join(grows(ids.distinct()), "id", "left_semi")
    wanted, seen = materialize(wanted)
    texts = docs.select(*(c.alias(n) for n, c in row_keys(id_col, text_col).items()), F.col(text_col).alias("text"))
    found = texts.join(broadcast_if_small(wanted, seen["bytes"]), ["k1", "k2"]).select("id", "text")
    written, got = materialize(found)
    # Rows that repeat an id with its text stand for the same set.
    return written if got["rows"] == seen["rows"] else materialize(written.dropDuplicates(["id"]))[0]


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs whose whole shingle sets reach the threshold."""
    percent = round(100 * threshold)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            known: dict[int, np.ndarray] = {}
            ids, others = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for a, x, y in zip(ids, batch.column("text_a"), batch.column("text_b")):
                if a not in known:
                    known = {a: shingle_set(x.as_py(), size)}
                left, right = known[a], shingle_set(y.as_py(), size)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()).filter(mask), pa.array(others, pa.int64()).filter(mask)], names=["a", "b"]
            )

    joined = pairs.join(grows(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))), "a")
    joined = joined.join(grows(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def labelled(rows: DataFrame, labels: DataFrame | None, name: str = "rep") -> DataFrame:
    """Add label_<name>, the label of the vertex in a column; without one, its own number."""
    if labels is None:
        return rows.withColumn(f"label_{name}", F.col(name))
    joined = rows.join(grows(labels.select(F.col("rep").alias(name), "label")), name, "left")
    return joined.withColumn(f"label_{name}", F.coalesce("label", name)).drop("label")


def components(signed: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, trees: int) -> DataFrame:
    """(set_key, component_id, keeper): the smallest doc_id of each set's component, and the number of the row that has it.

    `signed` has the rows of `signatures`, with ids and shingles, and their numbers (row).
    """
    # A set is named by the number of a row, which no other set has, whatever the ids are.
    named = F.min(F.struct("doc_id", "row", "k1", "k2", "n_shingles", "sketch")).alias("named")
    sets, seen = materialize(
        signed.groupBy("set_key").agg(named).select(
            "set_key", "named.doc_id", F.col("named.row").alias("rep"), "named.k1", "named.k2",
            F.col("named.n_shingles").alias("size"), "named.sketch",
        )
    )
    reps, seen = materialize(sets.select("rep"))
    slots = signed.select(F.col("row").alias("rep"), "slots").join(broadcast_if_small(reps, seen["bytes"]), "rep", "left_semi")
    slots, _ = materialize(slots)

    small, still, levels = small_nodes(slots, threshold, trees)
    large, grown = [still], trees
    while trees_for(levels) > grown:
        # Deeper nodes part more pairs; the trees that this takes may be deeper themselves.
        more = trees_for(levels)
        others, still, deepest = small_nodes(slots, threshold, more - grown, grown)
        small, grown, levels = small.unionByName(others), more, max(levels, deepest)
        large.append(still)
    sketches = sets.select("rep", "size", "sketch")
    leaves = small.select("node", "rep").join(grows(sketches), "rep").withColumn("label", F.col("rep"))
    found, _ = materialize(candidates(leaves, threshold))
    pairs = found.filter("b IS NOT NULL").select("a", "b")
    large = [nodes for nodes in large if nodes is not None]
    if large:
        rows = reduce(DataFrame.unionByName, large).select("node", "rep")
        large_nodes, _ = materialize(rows.join(grows(sketches), "rep"))
        pairs = pairs.unionByName(around_hubs(large_nodes, threshold))
    pairs, _ = materialize(pairs.groupBy("a", "b").agg(F.lit(1)).select("a", "b"))
    texts = texts_of(ends_of(pairs), sets, docs, id_col, text_col)

    # Each set with one other first; what that connects leaves few of the other pairs open.
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links, seen = materialize(confirmed(first, texts, size, threshold))
    labels = min_labels(links) if seen["rows"] else None
    rest = labelled(labelled(pairs, labels, "a"), labels, "b").filter("label_a <> label_b").select("a", "b")
    rest, seen = materialize(rest.join(grows(first), ["a", "b"], "left_anti"))
    if seen["rows"]:
        more_links, seen = materialize(confirmed(rest, texts, size, threshold))
        if seen["rows"]:
            links = links.unionByName(more_links)
            labels = min_labels(links)

    again = found.filter("b IS NULL").select("node", F.col("a").alias("rep"), "size", "sketch")
    open_nodes = labelled(again, labels).withColumnRenamed("label_rep", "label")
    if large:
        met = in_blocks(labelled(large_nodes, labels).withColumnRenamed("label_rep", "label"))
        open_nodes = open_nodes.unionByName(met)
    open_rows, seen = materialize(unsettled(open_nodes, threshold))
    if seen["rows"]:
        if large:  # members of blocks may have been in no pair
            missing = open_rows.select(F.col("rep").alias("id")).distinct().join(grows(texts.select("id")), "id", "left_anti")
            texts = texts.unionByName(texts_of(missing, sets, docs, id_col, text_col))
        more_links, seen = materialize(remaining_links(open_rows, texts, size, threshold))
        if seen["rows"]:
            labels = min_labels(links.unionByName(more_links))

    own = sets.select("set_key", "rep", "doc_id")
    if labels is None:
        return own.select("set_key", F.col("doc_id").alias("component_id"), F.col("rep").alias("keeper"))
    # Only sets with links have a label; of these the smallest id names the component.
    linked = own.join(grows(labels), "rep")
    first = linked.groupBy("label").agg(F.min(F.struct("doc_id", "rep")).alias("first"))
    of_linked = linked.join(grows(first), "label").select("set_key", "first")
    named = own.join(grows(of_linked), "set_key", "left").withColumn("first", F.coalesce("first", F.struct("doc_id", "rep")))
    return named.select("set_key", F.col("first.doc_id").alias("component_id"), F.col("first.rep").alias("keeper"))


def judged(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, threshold: float, trees: int) -> DataFrame:
    """Per row of `docs`: doc_id, k1, k2, n_shingles, component_id, and whether it is the one row its component keeps."""
    rows = signatures(docs, id_col, text_col, shingle_words).withColumn("row", F.monotonically_increasing_id())
    signed, seen = materialize(rows)
    takes_part = F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()
    named = components(signed.filter(takes_part), docs, id_col, text_col, shingle_words, threshold, trees)
    # A set of which there are many copies is met by rows of that many; its key is 16 bytes.
    joined = lookup(signed.filter(takes_part).drop("slots", "sketch"), "set_key", grows(named), F.col("row"), rows=seen["rows"])
    columns = ["doc_id", "k1", "k2", "n_shingles", "component_id", "keeper"]
    linked = joined.withColumn("keeper", F.col("row") == F.col("keeper")).select(*columns)
    alone = signed.filter(~takes_part).withColumns({"component_id": F.col("doc_id"), "keeper": F.lit(True)})
    return linked.unionByName(alone.select(*columns))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    trees: int = TREES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id and kept.

    Documents are linked when their sets of word shingles have a Jaccard similarity of at
    least `threshold`; component_id is the smallest id reachable over links, and `kept`
    marks the rows that have it. Equal sets are one vertex, so copies make no pairs.
    `trees` independent trees bring two linked documents into one small node: at
    similarity 0.8 a tree does so with a chance of about 0.63 after one level and 0.47 after
    two, so 14 trees miss fewer than one pair in a thousand, and components close over
    what is missed. Where large nodes take more levels, trees are added until that holds
    again. Candidates that connect each node are confirmed on whole sets, one for each set
    first, then those that these leave open; in the end, inside each node, all candidates
    that are still between different components.

    A null or empty text has no shingles and is linked with nothing. Rows with a null id
    take no part: component_id is null and kept true. Rows that repeat an id are each
    judged by their own text: two texts of one id are in one component only if links
    connect them. Other columns are ignored. A node above SMALL_NODE members branches
    further; after LEVELS levels its members, which then share as many random minwise
    tokens, meet its smallest one first, and those outside the component that holds most of
    the node then meet all, in blocks.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    found = judged(docs, id_col, text_col, shingle_words, threshold, trees)
    return found.select("doc_id", "n_shingles", "component_id", kept)


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    trees: int = TREES,
) -> DataFrame:
    """The rows of `docs` without those whose component keeps another row; all columns stay.

    A component keeps the row of its smallest id. Rows are told apart by id and text; of
    rows that repeat both one stays. Rows that share an id but no link stay side by side.
    """
    found = judged(docs, id_col, text_col, shingle_words, threshold, trees)
    # Rows of one key have one component, and either one keeper or none.
    keys = found.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("k1", "k2")
    gone = keys.agg(F.max("keeper").alias("stays"), F.count(F.lit(1)).alias("copies")).filter("NOT stays OR copies > 1")
    gone = gone.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("stays").alias("__stays"))
    gone, seen = materialize(gone, repeated=F.count_if("__stays"))
    listed = broadcast_if_small(gone, seen["bytes"])
    keys = row_keys(id_col, text_col)
    same = (keys["k1"] == listed["__k1"]) & (keys["k2"] == listed["__k2"])
    left = docs.join(listed, same, "left_anti")
    if not seen["repeated"]:
        return left
    one_each = docs.join(listed.filter("__stays"), same).dropDuplicates(["__k1", "__k2"])
    return left.unionByName(one_each.select(*docs.columns))
