"""PageRank over a directed graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.operators.vertices import Adjacency, IndexedGraph
from edgeline.runtime import lookup, materialize

# Damping and number of rounds.
DAMPING = 0.85
ROUNDS = 20


def pagerank(graph: IndexedGraph, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(vid, pagerank) after a fixed number of rounds; ranks sum to 1.

    A vertex passes its rank on in proportion to its edge weights. The rank held by
    vertices without outgoing edges is spread evenly, so each round gives all vertices the
    same base. What a base of 1 becomes after each number of steps along the edges is worked
    out once, with 0 left out; a rank adds these up, each times the base of its round. Steps
    end when all walks have: early where a graph has no long walks, at `rounds` at the latest.
    """
    n = graph.n_vertices
    out = graph.edges.groupBy("src").agg(F.sum("weight").alias("out_weight"))
    shares = (
        lookup(graph.edges, "src", out, by=F.col("dst"), rows=graph.n_edges, how="inner", keys=graph.edges)
        .select("src", "dst", (F.col("weight") / F.col("out_weight")).alias("share"))
        .filter(F.col("share").isNotNull())
    )
    # The first step starts from 1 at every vertex: edges alone give it.
    shares, _ = materialize(shares)
    adjacency = None
    walks, totals = [], [float(n)]
    for step in range(1, rounds + 1):
        if step == 1:
            messages = shares.select("dst", F.col("share").alias("part"))
        else:
            adjacency = adjacency or Adjacency(shares, graph.n_edges, "src", "dst")
            messages = adjacency.meet(walks[-1].withColumnRenamed("vid", "src")).select("dst", (F.col("part") * F.col("share")).alias("part"))
        arrived, seen = materialize(
            messages.groupBy(F.col("dst").alias("vid")).agg(F.sum("part").alias("part")), total=F.coalesce(F.sum("part"), F.lit(0.0))
        )
        totals.append(seen["total"])
        if not seen["rows"]:
            break
        walks.append(arrived)
    if adjacency:
        adjacency.release()
    totals += [0.0] * (rounds + 1 - len(totals))
    # What arrives in a step has left vertices with outgoing edges; the rest of the step before is held by the others.
    bases = [1.0 / n]
    for done in range(rounds):
        held = sum(bases[done - j] * damping**j * max(totals[j] - totals[j + 1], 0.0) for j in range(done + 1))
        bases.append((1.0 - damping) / n + damping * held / n)
    base = F.lit(bases[rounds]).alias("rank")
    terms = [graph.vertices.select("vid", base)]
    terms += [w.select("vid", (F.col("part") * bases[rounds - j] * damping**j).alias("rank")) for j, w in enumerate(walks, 1)]
    return reduce(DataFrame.unionByName, terms).groupBy("vid").agg(F.sum("rank").alias("pagerank"))
