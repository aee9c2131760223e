"""Connected components of the undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.operators.vertices import IndexedGraph
from edgeline.runtime import dense_index, lookup, materialize


def _roots(edges: DataFrame, n_edges: int) -> DataFrame:
    """(vid, label): every vertex with an edge, and the smallest vid of the tree it hooks into.

    A vertex hooks onto its smallest neighbour. Two steps along hooks never lead to a larger vid, so
    they end at two vertices hooked onto each other, of which the smaller is the root. Hooks are
    followed for the vertices hooked onto, in steps twice as long each time; the others ask once.
    """
    both = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("vid"), F.col("dst").alias("label")),
                F.struct(F.col("dst").alias("vid"), F.col("src").alias("label")),
            )
        )
    )
    hooks, size = materialize(both.groupBy("vid").agg(F.min("label").alias("label")))
    inner, seen = materialize(hooks.join(hooks.select(F.col("label").alias("vid")).distinct(), "vid", "left_semi"))
    first = True
    while True:
        step = inner.select(F.col("vid").alias("label"), F.col("label").alias("next"))
        ahead = lookup(inner, "label", step, by=F.col("vid"), rows=seen["rows"], how="inner", keys=inner)
        # Hooked onto each other: the smaller becomes the root, before any further step is taken.
        root = (F.col("next") == F.col("vid")) & (F.col("vid") < F.col("label"))
        label = F.when(root, F.col("vid")).otherwise(F.col("label")) if first else F.col("next")
        inner, seen = materialize(
            ahead.select("vid", label.alias("label"), F.col("label").alias("old")), changed=F.count_if(F.col("label") != F.col("old"))
        )
        inner = inner.select("vid", "label")
        if not first and not seen["changed"]:
            break
        first = False
    step = inner.select(F.col("vid").alias("label"), F.col("label").alias("root"))
    found = lookup(hooks, "label", step, by=F.col("vid"), rows=size["rows"], how="inner", keys=hooks)
    return materialize(found.select("vid", F.col("root").alias("label")))[0]


def smallest_member(graph: IndexedGraph) -> DataFrame:
    """(vid, label): the smallest vid of each vertex's component.

    Every round joins each vertex with its smallest neighbour and goes on with the trees so
    made as vertices, and only the edges between them. At most half the vertices with an edge are
    left after a round, however the graph lies.
    """
    edges, n_edges = graph.edges.select("src", "dst"), graph.n_edges
    levels = []
    while n_edges:
        labels = _roots(edges, n_edges)
        levels.append(labels)
        ends = lookup(edges, "src", labels.toDF("src", "a"), by=F.col("dst"), rows=n_edges, how="inner", keys=edges)
        ends = lookup(ends, "dst", labels.toDF("dst", "b"), by=F.col("src"), rows=n_edges, how="inner", keys=edges)
        between = ends.filter("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
        edges, seen = materialize(between)
        n_edges = seen["rows"]
    members = graph.vertices.select("vid", F.col("vid").alias("label"))
    if not levels:
        return members
    merged = levels.pop()
    while levels:
        step = merged.select(F.col("vid").alias("label"), F.col("label").alias("next"))
        below = lookup(levels.pop(), "label", step, by=F.col("vid"))
        merged = below.select("vid", F.coalesce("next", "label").alias("label"))
    merged = members.select("vid").join(merged, "vid", "left")
    return materialize(merged.select("vid", F.coalesce("label", "vid").alias("label")))[0]


def number_groups(labelled: DataFrame, name: str) -> DataFrame:
    """(vid, name): groups numbered 0, 1, 2, ... by their label."""
    numbers, _ = dense_index(labelled.select("label").distinct(), "label", name)
    return lookup(labelled, "label", numbers, by=F.col("vid"), how="inner").select("vid", name)


def connected_components(graph: IndexedGraph) -> DataFrame:
    """(vid, component_id), numbered from 0 by the smallest id in the component."""
    return number_groups(smallest_member(graph), "component_id")
