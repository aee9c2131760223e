"""Anchored traversal: neighbours, k-hop reach, connecting paths, subgraphs.

Each multi-hop operator writes its frontier once per hop. The next hop then reads
the edge table in a single scan that yields both directions, and joins it with a
frontier whose size is known: broadcast when small, shuffled otherwise. Results are
whole; a `limit` keeps the first rows of the stated order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.functions.expressions import both_directions, path_text
from edgeline.operators.vertices import Adjacency
from edgeline.operators.views import walk_hops
from edgeline.runtime import BROADCAST_BYTES, broadcast_if_small, materialize
from edgeline.schema import Graph

EDGE_COLUMNS = ("subject_id", "subject_type", "predicate", "object_id", "object_type", "confidence")


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _typed_neighbors(edges: DataFrame) -> DataFrame:
    """(entity_id, predicate, neighbor_id, neighbor_type, direction, confidence), two rows per edge."""
    ends = [("subject", "object", "out"), ("object", "subject", "in")]
    return edges.select(
        "predicate",
        "confidence",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.col(f"{near}_id").alias("entity_id"),
                        F.col(f"{far}_id").alias("neighbor_id"),
                        F.col(f"{far}_type").alias("neighbor_type"),
                        F.lit(direction).alias("direction"),
                    )
                    for near, far, direction in ends
                ]
            )
        ),
    ).select("entity_id", "predicate", "neighbor_id", "neighbor_type", "direction", "confidence")


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def _depth(k: int | None) -> float:
    return float("inf") if k is None else k


def neighbors(df: DataFrame, entity: str, limit: int | None = None) -> DataFrame:
    """Direct neighbours in both directions, most confident first."""
    touching = df.filter((F.col("subject_id") == entity) | (F.col("object_id") == entity))
    own = _typed_neighbors(touching).filter(F.col("entity_id") == entity).drop("entity_id")
    order = (F.desc_nulls_last("confidence"), "predicate", "neighbor_id", "direction", "neighbor_type")
    return _first(own.orderBy(*order), limit)


def neighbors_of(df: DataFrame, ids: DataFrame) -> DataFrame:
    """All direct neighbours of a table of ids (column `entity_id`)."""
    anchors, seen = materialize(ids.select("entity_id").distinct())
    return _typed_neighbors(df).join(broadcast_if_small(anchors, seen["bytes"]), "entity_id")


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(both_directions(F.col("subject_id"), F.col("object_id")))


def _levels(df: DataFrame, first: DataFrame, depth: float, back: bool = False) -> list[DataFrame]:
    """Breadth-first levels (anchor, node, hops); `first` holds the distinct pairs one hop away.

    An anchor does not reach itself, unless walks may come `back` to it.
    """
    level, seen = materialize(first.withColumn("hops", F.lit(1)))
    levels, adjacency = [level], None
    while seen["rows"] and len(levels) < depth:
        # A neighbour of the current level lies one level back, here, or one further on.
        visited = _union(levels[-2:]).select("anchor", "node")
        frontier = level.select("anchor", F.col("node").alias("src"))
        if adjacency is None and seen["bytes"] > BROADCAST_BYTES and len(levels) + 1 < depth:
            # This hop and later ones would shuffle all pairs: they are shuffled once.
            pairs = _pairs(df).filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
            adjacency = Adjacency(pairs, pairs.count(), "src", "dst")
        if adjacency is None or seen["bytes"] <= BROADCAST_BYTES:
            met = _pairs(df).join(broadcast_if_small(frontier, seen["bytes"]), "src")
        else:
            met = adjacency.meet(frontier)
        reached = (
            met.filter(F.col("dst").isNotNull() & (F.lit(back) | (F.col("dst") != F.col("anchor"))))
            .select("anchor", F.col("dst").alias("node"))
            .distinct()
        )
        level, seen = materialize(
            reached.join(visited, ["anchor", "node"], "left_anti").withColumn("hops", F.lit(len(levels) + 1))
        )
        levels.append(level)
    if adjacency is not None:
        adjacency.release()
    return levels


def khop(df: DataFrame, entity: str, k: int | None = None, limit: int | None = None) -> DataFrame:
    """Entities within k undirected hops, with no k at any distance, and their smallest hop count; nearest first."""
    if _depth(k) <= 0:
        return df.sparkSession.createDataFrame([], "neighbor_id string, hops int")
    touching = df.filter((F.col("subject_id") == entity) | (F.col("object_id") == entity))
    first = (
        _pairs(touching)
        .filter((F.col("src") == entity) & (F.col("dst") != entity))
        .select(F.col("src").alias("anchor"), F.col("dst").alias("node"))
        .distinct()
    )
    found = _union(_levels(df, first, _depth(k))).select(F.col("node").alias("neighbor_id"), "hops")
    return _first(found.orderBy("hops", "neighbor_id"), limit)


def _first_hops(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct (anchor, node) one hop away from a table of ids (column `src`), written once."""
    anchors, seen = materialize(ids.select("src").distinct())
    near = (
        _pairs(df)
        .join(broadcast_if_small(anchors, seen["bytes"]), "src")
        .filter(F.col("dst") != F.col("src"))
        .select(F.col("src").alias("anchor"), F.col("dst").alias("node"))
        .distinct()
    )
    return materialize(near)[0]


def _alike(near: DataFrame) -> tuple[DataFrame, int]:
    """(anchor, like) and its bytes: anchors next to the same nodes, and one of them for all.

    Hashes propose who is alike; the sets themselves are then compared.
    """
    hashes = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"h{seed}") for seed in (0, 1)]
    sets = near.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), *hashes)
    firsts = sets.groupBy("n", "h0", "h1").agg(F.min("anchor").alias("like"))
    proposed, seen = materialize(sets.join(firsts, ["n", "h0", "h1"]).select("anchor", "like", "n"))
    others = broadcast_if_small(proposed.filter("anchor <> like"), seen["bytes"])
    shared = near.join(others, "anchor").join(near.withColumnRenamed("anchor", "like"), ["like", "node"])
    same = shared.groupBy("anchor", "n").agg(F.count(F.lit(1)).alias("both")).filter("n = both").select("anchor")
    checked = proposed.join(same.withColumn("same", F.lit(True)), "anchor", "left")
    alike, seen = materialize(checked.select("anchor", F.when(F.col("same"), F.col("like")).otherwise(F.col("anchor")).alias("like")))
    return alike, seen["bytes"]


def khop_of(df: DataFrame, ids: DataFrame, k: int | None = None) -> DataFrame:
    """(entity_id, neighbor_id, hops) for a table of ids, complete for every anchor.

    Anchors next to the same nodes reach the same entities, but for themselves: their levels
    are searched once, and copied to each of them in the result.
    """
    if _depth(k) <= 0:
        return df.sparkSession.createDataFrame([], "entity_id string, neighbor_id string, hops int")
    near = _first_hops(df, ids.select(F.col("entity_id").alias("src")))
    alike, size = _alike(near)
    first = near.join(alike.filter("anchor = like").select("anchor"), "anchor", "left_semi")
    reached = _union(_levels(df, first, _depth(k), back=True)).withColumnRenamed("anchor", "like")
    return (
        reached.join(broadcast_if_small(alike, size), "like")
        .filter(F.col("node") != F.col("anchor"))
        .select(F.col("anchor").alias("entity_id"), F.col("node").alias("neighbor_id"), "hops")
    )


def _paths(df: DataFrame, pairs: DataFrame, max_hops: int, limit: int | None = None) -> DataFrame:
    """(pair, hops, path) of the simple undirected paths between the ends a and b of each pair.

    Paths grow from one end, after their first hop only over nodes that can still reach the
    other end in time. The side with fewer different ends is the one whose
    distances are searched. A node is asked for its neighbours once per far end, however
    many paths stand on it. With a `limit`, which is for a single pair, longer paths are only
    built while shorter ones do not fill it.
    """
    if max_hops < 1:
        raise ValueError("a path has at least one hop")
    direct = _pairs(df).join(pairs, (F.col("src") == F.col("a")) & (F.col("dst") == F.col("b")))
    found = direct.select("pair", F.lit(1).alias("hops"), path_text(F.col("a"), F.col("b")).alias("path")).distinct()
    if max_hops == 1:
        return found
    sides = pairs.agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).first()
    turned = sides["b"] > sides["a"]
    start, end = ("b", "a") if turned else ("a", "b")
    steps = _pairs(df).filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    searched = max(max_hops - 2, 1)
    levels = _levels(df, _first_hops(df, pairs.select(F.col(end).alias("src"))), searched)
    left = _union(levels).select(F.col("anchor").alias("end"), F.col("node").alias("dst"), F.col("hops").alias("left"))
    left, left_size = materialize(left)
    tips, size = materialize(
        pairs.select("pair", F.col(start).alias("start"), F.col(end).alias("end"), F.col(start).alias("tip"),
                     F.array().cast("array<string>").alias("inner"))
    )
    for hops in range(2, max_hops + 1):
        # Paths whose last inner node is `hops - 1` away from their start.
        asked, asked_size = materialize(tips.select("end", F.col("tip").alias("src")).distinct())
        onward = steps.join(broadcast_if_small(asked, asked_size["bytes"]), "src").filter(F.col("dst") != F.col("end"))
        in_time = left.filter(F.col("left") <= max_hops - hops + 1)
        onward = onward.join(
            broadcast_if_small(in_time, left_size["bytes"]), ["end", "dst"], "inner" if max_hops - hops + 1 <= searched else "left"
        )
        onward, onward_size = materialize(onward.select("end", F.col("src").alias("tip"), "dst", "left").distinct())
        tips, size = materialize(
            broadcast_if_small(tips.drop("left"), size["bytes"])
            .join(broadcast_if_small(onward, onward_size["bytes"]), ["end", "tip"])
            .filter((F.col("dst") != F.col("start")) & ~F.array_contains("inner", F.col("dst")))
            .select("pair", "start", "end", F.col("dst").alias("tip"), F.array_append("inner", F.col("dst")).alias("inner"), "left")
        )
        nodes = F.concat(F.array("start"), "inner", F.array("end"))
        arrived = tips.filter("left = 1").select(
            "pair", F.lit(hops).alias("hops"), F.array_join(F.reverse(nodes) if turned else nodes, " -> ").alias("path")
        )
        found = found.unionByName(arrived)
        if limit is not None:
            found, seen = materialize(found.orderBy("hops", "path").limit(limit))
            if seen["rows"] == limit:
                break
        if not size["rows"]:
            break
    return found


def connection_paths(df: DataFrame, a: str, b: str, max_hops: int = 4, limit: int | None = None) -> DataFrame:
    """Simple undirected paths from a to b, shortest first. For a = b they are the loops through a."""
    pair = df.sparkSession.range(1).select(F.lit(0).alias("pair"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    pair, _ = materialize(pair)
    found = _paths(df, pair, max_hops, limit).select("hops", "path").orderBy("hops", "path")
    return _first(found, limit)


def connection_paths_of(df: DataFrame, pairs: DataFrame, max_hops: int = 4) -> DataFrame:
    """(a, b, hops, path) for a table of pairs a, b: all simple undirected paths of each."""
    numbered, _ = materialize(
        pairs.select("a", "b").distinct().withColumn("pair", F.struct("a", "b"))
    )
    return _paths(df, numbered, max_hops).select("pair.a", "pair.b", "hops", "path")


def edges_touching(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct edge rows with an end in `ids` (column `node_id`), which are written once and measured.

    An either-end join condition would make Spark compare every pair. With a broadcastable
    id table one scan checks both ends; otherwise each end gets its own semi-join and the
    two results are merged.
    """
    ids, seen = materialize(ids.select("node_id").distinct())
    if seen["bytes"] <= BROADCAST_BYTES:
        by_subject = F.broadcast(ids.select(F.col("node_id").alias("hit_subject")))
        by_object = F.broadcast(ids.select(F.col("node_id").alias("hit_object")))
        return (
            df.join(by_subject, F.col("subject_id") == F.col("hit_subject"), "left")
            .join(by_object, F.col("object_id") == F.col("hit_object"), "left")
            .filter(F.col("hit_subject").isNotNull() | F.col("hit_object").isNotNull())
            .select(*df.columns)
            .distinct()
        )
    by_subject = ids.select(F.col("node_id").alias("subject_id"))
    by_object = ids.select(F.col("node_id").alias("object_id"))
    hit_subject = df.join(by_subject, "subject_id", "left_semi").select(*df.columns)
    hit_object = df.join(by_object, "object_id", "left_semi").select(*df.columns)
    return hit_subject.unionByName(hit_object).distinct()


def subgraph_edges(df: DataFrame, entity: str, k: int | None = 2, limit: int | None = None) -> DataFrame:
    """Edge rows with the hop at which a walk from the entity meets them first, up to k; with no k all it can meet.

    Hop 1 are those touching the entity, whatever k is, and hop h those touching a node
    h - 1 hops away. Identical rows collapse, parallel ones that differ stay.
    """
    ids = df.sparkSession.range(1).select(F.lit(entity).alias("entity_id"))
    found = subgraph_edges_of(df, ids, k).drop("entity_id")
    tie_break = [F.asc_nulls_last(c) for c in ("predicate", "confidence", "subject_type", "object_type")]
    return _first(found.orderBy("hop", "subject_id", "object_id", *tie_break), limit)


def subgraph_edges_of(df: DataFrame, ids: DataFrame, k: int | None = 2) -> DataFrame:
    """The rows of `subgraph_edges` for every id of a table (column `entity_id`)."""
    edges = df.select(*EDGE_COLUMNS)
    anchors, _ = materialize(ids.select("entity_id").distinct())
    reached = [anchors.select("entity_id", F.col("entity_id").alias("node"), F.lit(0).alias("hops"))]
    depth = max(_depth(k), 1)
    if depth > 1:
        near = khop_of(df, anchors, None if k is None else k - 1)
        reached.append(near.select("entity_id", F.col("neighbor_id").alias("node"), "hops"))
    nodes, seen = materialize(_union(reached))
    if seen["bytes"] <= BROADCAST_BYTES:
        nodes = F.broadcast(nodes)
    at = nodes.select("entity_id", F.col("node"), (F.col("hops") + 1).alias("hop"))
    by_subject = edges.join(at, edges["subject_id"] == at["node"])
    by_object = edges.join(at, edges["object_id"] == at["node"])
    touched = by_subject.unionByName(by_object).drop("node")
    return touched.groupBy("entity_id", *EDGE_COLUMNS).agg(F.min("hop").alias("hop"))


def _hops_to(graph: Graph, end: str, k: int) -> DataFrame:
    """(node, left): nodes from which `end` is at most k directed hops away, with the fewest hops."""
    cols = graph.cols
    steps = graph.edges.select(F.col(cols.src).alias("node"), F.col(cols.dst).alias("next"))
    level = graph.edges.sparkSession.range(1).select(F.lit(end).alias("node"), F.lit(0).alias("left"))
    level, seen = materialize(level)
    levels = [level]
    for hop in range(1, k + 1):
        frontier = broadcast_if_small(level.select(F.col("node").alias("next")), seen["bytes"])
        before = steps.join(frontier, "next").select("node").filter(F.col("node").isNotNull()).distinct()
        known = _union(levels).select("node")
        level, seen = materialize(before.join(known, "node", "left_anti").withColumn("left", F.lit(hop)))
        if not seen["rows"]:
            break
        levels.append(level)
    return _union(levels)


def connects(graph: Graph, a: str, b: str, k: int = 3, n: int = 5) -> DataFrame:
    """The n shortest directed walks from a to b; if there is none, from b to a.

    Hops are built one at a time and stop once n walks are found: a longer walk can't
    come before them. Only walks go on whose last node can still reach the end in time.
    """
    order = ["hop", "path", *(["predicates"] if graph.cols.label else [])]
    for start, end, direction in ((a, b, "forward"), (b, a, "reverse")):
        found = None
        for hop in walk_hops(graph, k, start, toward=_hops_to(graph, end, k)):
            hit = hop.filter(F.col("reached_id") == end).withColumn("direction", F.lit(direction))
            best = hit if found is None else found.unionByName(hit)
            found, seen = materialize(best.orderBy(*order).limit(n))
            if seen["rows"] == n:
                break
        if seen["rows"]:
            break
    return found.orderBy(*order)
