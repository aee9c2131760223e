"""Approximate nearest neighbours over balanced posting lists, found through a graph of their centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeline.runtime import materialize

# The index is fitted on about this many rows, chosen by a hash of the id, and has at most
# so many lists; both bound what the driver holds and hands out. Every row is indexed.
SAMPLE_ROWS = 20_000
MAX_LISTS = 4096
ROWS_PER_LIST = 200
# Boundary vectors go into further lists, MEAN_REPLICAS lists a vector on average over the
# sample and MAX_REPLICAS at most.
MEAN_REPLICAS = 2.0
MAX_REPLICAS = 8
# A further list is left out only if its centroid is nearer to that of a list already taken
# than this part of the usual distance between neighbouring centroids.
SAME_PLACE = 0.5
# Share of the sample's true neighbours that the lists read must hold. Neighbours among all
# rows are nearer than those in a sample, so that more of them are found.
TARGET_RECALL = 0.95
# Sampled rows asked for their neighbours in the sample when the ratios are chosen.
HELD_OUT = 400
# Rows of one list that are compared with rows of queries in one step.
BLOCK_ROWS = 20_000
# Rows handed on at once, each with its vector: a query may read thousands of lists.
BATCH_ROWS = 10_000
# A query that a walk to so many lists leaves unsettled is compared with all centroids instead.
WALKED = 128


@dataclass
class Index:
    centroids: np.ndarray  # one row per list, with the added coordinate
    neighbours: np.ndarray  # arcs of the graph, -1 where there are fewer
    entries: np.ndarray  # where a search begins
    norm: float  # the largest norm of an indexed vector
    dims: int
    spacing: float = 0.0  # the median distance of a centroid from its nearest one
    replica_ratio: float = 1.0  # lists up to so many times as far as the nearest one hold a vector too
    search_ratio: float = 1.0  # and are read for a query

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Indexed vectors with one more coordinate that gives all the same norm: nearest is then largest inner product."""
        rest = np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def lift_queries(self, vectors: np.ndarray) -> np.ndarray:
        scale = self.norm / np.sqrt((vectors**2).sum(axis=1))
        return np.hstack([vectors * scale[:, None], np.zeros((len(vectors), 1))])

    def search(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids that a best-first walk of the graph finds for each point, and their distances."""
        n, lists = len(points), len(self.centroids)
        width = min(width, lists)
        rows = np.arange(n)[:, None]
        norms = (self.centroids**2).sum(axis=1)
        own = (points**2).sum(axis=1)

        def distance(row: np.ndarray, to: np.ndarray) -> np.ndarray:
            inner = np.einsum("rkd,rd->rk", self.centroids[to], points[row])
            return np.sqrt(np.maximum(norms[to] - 2 * inner + own[row][:, None], 0))

        seen = np.zeros((n, lists), bool)
        seen[:, self.entries] = True
        found = np.full((n, max(width, len(self.entries))), -1)
        far = np.full(found.shape, np.inf)
        found[:, : len(self.entries)] = self.entries
        far[:, : len(self.entries)] = distance(np.arange(n), np.broadcast_to(self.entries, (n, len(self.entries))))
        done = np.zeros(found.shape, bool)
        active = np.arange(n)
        while len(active):
            open_ = np.where(done[active] | (found[active] < 0), np.inf, far[active])
            at = open_.argmin(axis=1)
            going = np.isfinite(open_[np.arange(len(active)), at])
            active, at = active[going], at[going]
            if not len(active):
                break
            done[active, at] = True
            near = self.neighbours[found[active, at]]
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(near >= 0, near, self.entries[0])] = True
            reach = np.where(fresh, distance(active, np.maximum(near, 0)), np.inf)
            all_found = np.hstack([found[active], np.where(fresh, near, -1)])
            all_far = np.hstack([far[active], reach])
            all_done = np.hstack([done[active], np.zeros(near.shape, bool)])
            best = np.argsort(all_far, axis=1, kind="stable")[:, : found.shape[1]]
            line = np.arange(len(active))[:, None]
            found[active], far[active], done[active] = all_found[line, best], all_far[line, best], all_done[line, best]
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        return found[rows, order], far[rows, order]

    def postings(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists of each indexed vector: the nearest one and, for those between several, the others."""
        return self.spread(*self.search(self.lift(vectors), 2 * MAX_REPLICAS))

    def spread(self, found: np.ndarray, far: np.ndarray) -> list[list[int]]:
        out = []
        for near, distances in zip(found, far):
            taken: list[int] = []
            for c, d in zip(near.tolist(), distances.tolist()):
                if c < 0 or d > self.replica_ratio * distances[0] or len(taken) == MAX_REPLICAS:
                    break
                apart = ((self.centroids[taken] - self.centroids[c]) ** 2).sum(axis=1)
                if not len(apart) or (apart >= (SAME_PLACE * self.spacing) ** 2).all():
                    taken.append(c)
            out.append(taken)
        return out

    def tune(self, sample: np.ndarray, k: int, target: float, rng: np.random.Generator) -> None:
        """Choose both ratios by the sample: so many replicas on average, and the least search that finds so many neighbours."""
        points = self.lift(sample)
        found, far = self.search(points, 2 * MAX_REPLICAS)
        if len(self.centroids) < 2:
            return
        ratios = np.where(found >= 0, far, np.inf) / np.maximum(far[:, :1], 1e-300)
        # Of all further lists of the sample, nearest first, so many that the average is met.
        wanted = int((MEAN_REPLICAS - 1) * len(sample))
        further = np.sort(ratios[:, 1:MAX_REPLICAS].ravel())
        self.replica_ratio = float(further[min(wanted, len(further) - 1)])
        lists = self.spread(found, far)
        asked = rng.choice(len(sample), min(HELD_OUT, len(sample)), replace=False)
        asked = asked[(sample[asked] != 0).any(axis=1)]
        centres = self.lift_queries(sample[asked])
        apart = np.sqrt(
            np.maximum((self.centroids**2).sum(axis=1) - 2 * centres @ self.centroids.T + (centres**2).sum(axis=1)[:, None], 0)
        )
        apart /= np.maximum(apart.min(axis=1, keepdims=True), 1e-300)
        scores = sample[asked] @ sample.T
        scores[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(sample) - 1)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.zeros((len(asked), 0), int)
        # The ratio at which a search comes to a list of each true neighbour.
        needed = np.array([apart[i, lists[row]].min() for i, rows in enumerate(best) for row in rows])
        if len(needed):
            self.search_ratio = float(np.quantile(needed, target, method="higher")) * (1 + 1e-9)

    def probes(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists each query reads; the walk widens until it has passed the ratio, and beyond WALKED lists all are looked at."""
        ratio = self.search_ratio
        points, lists = self.lift_queries(vectors), len(self.centroids)
        out: list[list[int]] = [[] for _ in vectors]
        left, width = np.arange(len(vectors)), 32
        while len(left):
            if WALKED < width < lists:
                norms, some = (self.centroids**2).sum(axis=1), points[left]
                far = np.sqrt(np.maximum(norms - 2 * some @ self.centroids.T + (some**2).sum(axis=1)[:, None], 0))
                found = np.argsort(far, axis=1, kind="stable")
                far, width = np.take_along_axis(far, found, 1), lists
            else:
                found, far = self.search(points[left], width)
            short = far[:, -1] <= ratio * far[:, 0]
            if width >= lists:
                short[:] = False
            for i, near, distances in zip(left[~short], found[~short], far[~short]):
                out[i] = near[(distances <= ratio * distances[0]) & (near >= 0)].tolist()
            left, width = left[short], 2 * width
        return out


def halves(points: np.ndarray, rows: np.ndarray, lists: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Rows in `lists` groups of equal size: each cut splits at the median between two means."""
    if lists == 1 or len(rows) < 2:
        return [rows]
    part = points[rows]
    means = part[rng.choice(len(part), 2, replace=False)]
    for _ in range(4):
        side = ((part - means[0]) ** 2).sum(axis=1) > ((part - means[1]) ** 2).sum(axis=1)
        if side.all() or not side.any():
            break
        means = np.stack([part[~side].mean(axis=0), part[side].mean(axis=0)])
    order = np.argsort(part @ (means[1] - means[0]), kind="stable")
    cut = len(rows) // 2
    return halves(points, rows[order[:cut]], lists // 2, rng) + halves(points, rows[order[cut:]], lists // 2, rng)


def graph_of(centroids: np.ndarray, arcs: int = 24) -> np.ndarray:
    """For each centroid its near neighbours, leaving out those that are nearer to one already taken; the rest fills up."""
    n = len(centroids)
    norms = (centroids**2).sum(axis=1)
    out = np.full((n, arcs), -1)
    for i in range(n):
        far = norms - 2 * centroids @ centroids[i] + norms[i]
        near = np.argsort(far, kind="stable")[: 4 * arcs + 1]
        near = near[near != i]
        taken: list[int] = []
        for c in near.tolist():
            if len(taken) < arcs and all(((centroids[t] - centroids[c]) ** 2).sum() > far[c] for t in taken):
                taken.append(c)
        taken += [c for c in near.tolist() if c not in taken][: arcs - len(taken)]
        out[i, : len(taken)] = taken
    return out


def reached(neighbours: np.ndarray, entries: list[int]) -> np.ndarray:
    seen = np.zeros(len(neighbours), bool)
    todo = list(entries)
    while todo:
        i = todo.pop()
        if not seen[i]:
            seen[i] = True
            todo += [int(j) for j in neighbours[i] if j >= 0 and not seen[j]]
    return seen


def fit(sample: np.ndarray, rows: int, norm: float, k: int = 20, target: float = TARGET_RECALL, seed: int = 1) -> Index:
    """Lists for `rows` vectors from a sample of them, with ratios chosen for the k nearest."""
    index = Index(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), norm, sample.shape[1])
    points = index.lift(sample)
    wanted = min(MAX_LISTS, max(1, rows // ROWS_PER_LIST), len(points))
    lists = 1 << wanted.bit_length() - 1
    rng = np.random.default_rng(seed)
    groups = halves(points, np.arange(len(points)), lists, rng)
    index.centroids = np.stack([points[g].mean(axis=0) for g in groups])
    index.neighbours = graph_of(index.centroids)
    if len(groups) > 1:
        nearest_one = index.centroids[index.neighbours[:, 0]]
        index.spacing = float(np.median(np.sqrt(((index.centroids - nearest_one) ** 2).sum(axis=1))))
    entries = list(range(0, len(groups), max(1, len(groups) // 16)))
    while not (seen := reached(index.neighbours, entries)).all():
        entries.append(int(np.flatnonzero(~seen)[0]))
    index.entries = np.array(entries)
    index.tune(sample, k, target, rng)
    return index


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vector) of rows with an id and a vector that takes part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(sound & some)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


LISTED = "list int, vec_id long, vector array<double>"


def dealt(rows: DataFrame, lists_of, dims: int) -> DataFrame:
    """(list, vec_id, vector) for every list that `lists_of` gives a row's vector."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                lists = lists_of(matrix(some.column("vector"), dims))
                row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                flat = np.array([c for x in lists for c in x], np.int32)
                for first in range(0, len(row), BATCH_ROWS):
                    copied = pa.array(row[first : first + BATCH_ROWS])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(flat[first : first + BATCH_ROWS]),
                            some.column("vec_id").take(copied),
                            some.column("vector").take(copied),
                        ],
                        names=["list", "vec_id", "vector"],
                    )

    return rows.mapInArrow(deal, LISTED)


def best_of_block(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """For each query the k best rows of a block by exact score, then id; ids are distinct, the query's own is left out.

    Products of matrices choose a few more rows than k, as far as rounding could matter;
    those are scored by themselves.
    """
    rough = queries @ vectors.T
    own = ids[None, :] == query_ids[:, None]
    rough[own] = -np.inf
    wide = min(len(ids), 2 * k + 8)
    near = np.argpartition(-rough, wide - 1, axis=1)[:, :wide]
    if wide < len(ids):
        least = np.take_along_axis(rough, near, 1).min(axis=1)
        kth = -np.sort(-np.take_along_axis(rough, near, 1), axis=1)[:, k - 1]
        unclear = np.isfinite(kth) & (kth - least <= 1e-9 * (1 + np.abs(kth)))
    else:
        unclear = np.zeros(len(queries), bool)
    exact = np.einsum("qwd,qd->qw", vectors[near], queries)
    exact[np.take_along_axis(own, near, 1)] = -np.inf
    order = np.lexsort((ids[near], -exact), axis=1)[:, :k]
    names, scores = np.take_along_axis(ids[near], order, 1), np.take_along_axis(exact, order, 1)
    for q in range(len(queries)):
        if unclear[q]:  # many rows as good as the last one
            all_exact = np.einsum("nd,d->n", vectors, queries[q])
            all_exact[own[q]] = -np.inf
            best = np.lexsort((ids, -all_exact))[:k]
            yield ids[best][np.isfinite(all_exact[best])], all_exact[best][np.isfinite(all_exact[best])]
        else:
            sound = np.isfinite(scores[q])
            yield names[q][sound], scores[q][sound]


def rows_apart(ids: np.ndarray) -> list[np.ndarray]:
    """Rows in parts within which no id repeats; one part where none does."""
    order = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.diff(ids[order], prepend=ids[order][:1] - 1)) if len(ids) else order
    nth = np.empty(len(ids), np.int64)
    nth[order] = np.arange(len(ids)) - np.repeat(firsts, np.diff(firsts, append=len(ids)))
    return [np.flatnonzero(nth == i) for i in range(int(nth.max(initial=-1)) + 1)]


def search_blocks(stored: DataFrame, asked: DataFrame, dims: int, k: int, block_rows: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of every list for the queries that read it.

    Large lists are cut into blocks of rows, and so are the queries that read one list;
    each block of rows meets each block of queries of its list in one task.
    """

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
        return sizes.select("list", F.ceil(F.col("n") / block_rows).cast("int").alias(name))

    # One row per list, of which there are MAX_LISTS at most.
    cuts = F.broadcast(blocks(stored, "row_blocks").join(F.broadcast(blocks(asked, "query_blocks")), "list"))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).cast("int")
    rows = stored.join(cuts, "list").withColumn("row_block", mine)
    rows = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    theirs = F.pmod(F.xxhash64("vec_id"), F.col("query_blocks")).cast("int")
    queries = asked.join(cuts, "list").withColumn("query_block", theirs)
    queries = queries.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_ids", "scores"]
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            all_ids = left["vec_id"].to_numpy()
            all_vectors = matrix(left["vector"].combine_chunks(), dims)
            asked_ids = right["vec_id"].to_numpy()
            points = matrix(right["vector"].combine_chunks(), dims)
            for part in rows_apart(all_ids):
                ids, vectors = all_ids[part], all_vectors[part]
                for at in range(0, len(points), 256):
                    own = asked_ids[at : at + 256]
                    out[0] += own.tolist()
                    for found, scores in best_of_block(ids, vectors, points[at : at + 256], own, k):
                        out[1].append(found)
                        out[2].append(scores)
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    keys = ("list", "row_block", "query_block")
    pick = (*keys, "vec_id", "vector")
    met = rows.select(*pick).groupBy(*keys).cogroup(queries.select(*pick).groupBy(*keys))
    found = met.applyInArrow(compare, "query_id long, vec_ids array<long>, scores array<double>")
    return found.groupBy("query_id").applyInArrow(merged(k), "query_id long, vec_id long, score double")


def merged(k: int):
    """The k best of one query out of what its lists gave, an id once."""

    def merge(table: pa.Table) -> pa.Table:
        ids = table["vec_ids"].combine_chunks().flatten().to_numpy()
        scores = table["scores"].combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, -scores))
        _, first = np.unique(ids[order], return_index=True)
        best = order[np.sort(first)[:k]]
        query = np.full(len(best), table["query_id"][0].as_py(), np.int64)
        return pa.Table.from_arrays(
            [pa.array(query), pa.array(ids[best], pa.int64()), pa.array(scores[best], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    return merge


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    target_recall: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    report: dict | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of largest inner product that its lists hold.

    Scores are exact, on the original vectors in double precision; equal ones are ranked
    by vec_id. A query's own id is no neighbour. Lists are fitted on about `sample_rows`
    rows and hold every row, boundary vectors several times; a query reads the lists up to
    a ratio of distances, the least at which the lists of held-out sampled rows hold
    `target_recall` of their neighbours in the sample. `report` is given the mean number of
    lists of a row, both ratios, and the share of the rows that a query reads on average.
    A query whose lists hold under k rows reads all lists. Rows with a null id, and vectors
    that are null, zero, empty, of another length than most, or hold null or non-finite
    components take no part. A repeated id counts once, by its best score. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    result = T.StructType.fromDDL("query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vec_col)
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("square")
    )
    shape = lengths.orderBy(F.desc("n"), "dims").limit(1).collect()
    if not shape:
        return spark.createDataFrame([], result)
    dims, count, norm = shape[0]["dims"], shape[0]["n"], float(np.sqrt(shape[0]["square"]))
    rows = rows.filter(F.size("vector") == dims)
    share = min(1.0, sample_rows / count)
    chance = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = rows.filter(chance).select("vector").limit(2 * sample_rows).toArrow()
    if not sample.num_rows:
        sample = rows.select("vector").limit(1).toArrow()
    index = fit(matrix(sample["vector"].combine_chunks(), dims), count, norm, k, target_recall)
    shared = spark.sparkContext.broadcast(index)

    asked = usable(queries, id_col, vec_col).filter(F.size("vector") == dims)
    stored, held = materialize(dealt(rows, lambda v: shared.value.postings(v), dims))
    probes, read = materialize(dealt(asked, lambda v: shared.value.probes(v), dims))
    if report is not None:
        sizes = stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
        met = probes.join(F.broadcast(sizes), "list").agg(F.sum("n").alias("met"), F.count_distinct("vec_id").alias("queries")).first()
        report |= {"lists": len(index.centroids), "replicas": held["rows"] / count, "probes": read["rows"] / max(met["queries"], 1)}
        report |= {"replica_ratio": index.replica_ratio, "search_ratio": index.search_ratio}
        report["share_read"] = (met["met"] or 0) / max(met["queries"], 1) / count
    scored, _ = materialize(search_blocks(stored, probes, dims, k, block_rows))
    counts = scored.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = asked.join(counts, asked["vec_id"] == counts["query_id"], "left_anti")
    short, seen = materialize(short)
    if seen["rows"]:
        everywhere = dealt(short, lambda v: [list(range(len(shared.value.centroids)))] * len(v), dims)
        more = search_blocks(stored, everywhere, dims, k, block_rows)
        scored = scored.unionByName(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")
    ranked = scored.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
