"""Distances from one seed along directed edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.functions.expressions import edge_weight
from edgeline.operators.statistics import undirected_degree
from edgeline.runtime import broadcast_if_small, materialize


# Tables of improved distances that are made one when there are so many.
MERGE_TABLES = 8


def highest_degree(edges: DataFrame) -> DataFrame:
    """One row: the id with most distinct neighbours, smallest id on ties."""
    return undirected_degree(edges).orderBy(F.desc("degree"), "id").limit(1)


def default_seed(edges: DataFrame) -> str:
    return highest_degree(edges).first()["id"]


def bfs(edges: DataFrame, seed: str) -> DataFrame:
    """(id, distance) in hops for every vertex reachable from the seed. `edges`: src, dst."""
    edges, _ = materialize(edges.select("src", "dst").filter(F.col("src") != F.col("dst")))
    start = edges.sparkSession.range(1).select(F.lit(seed).alias("id"), F.lit(0).alias("distance"))
    level, seen = materialize(start)
    levels = [level]
    while seen["rows"]:
        reached = (
            edges.join(broadcast_if_small(level.select(F.col("id").alias("src")), seen["bytes"]), "src")
            .select(F.col("dst").alias("id"))
            .distinct()
        )
        known = reduce(DataFrame.unionByName, levels).select("id")
        level, seen = materialize(
            reached.join(known, "id", "left_anti").withColumn("distance", F.lit(len(levels)))
        )
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def sssp(df: DataFrame, seed: str, cost: Column | None = None, delta: float | None = None) -> DataFrame:
    """(id, distance) of least total cost for every vertex reachable from the seed.

    `df` has subject_id, object_id and confidence. The cost of an edge defaults to its
    weight, so more confident edges are longer; pass `cost` for another rule (positive).

    Delta-stepping: of the vertices whose distance improved, each round extends those
    within `delta` (four times the mean cost of an edge by default) of the nearest one, so
    that few are extended again. A round writes the offers it makes, and what waits with
    what improved; distances known before are read for the vertices that have an offer,
    and not rewritten.
    """
    cost = edge_weight(F.col("confidence")) if cost is None else cost
    edges, seen = materialize(
        df.filter(F.col("subject_id") != F.col("object_id"))
        .groupBy(F.col("subject_id").alias("src"), F.col("object_id").alias("dst"))
        .agg(F.min(cost).alias("cost")),
        mean=F.avg("cost"),
    )
    step = delta if delta is not None or seen["mean"] is None else 4 * seen["mean"]
    start = df.sparkSession.range(1).select(F.lit(seed).alias("id"), F.lit(0.0).alias("distance"))
    waiting, seen = materialize(start.withColumn("fresh", F.lit(True)), nearest=F.min("distance"))
    improvements = [waiting.select("id", "distance")]
    while seen["rows"]:
        near = F.lit(True) if step is None else F.col("distance") <= F.lit(seen["nearest"] + step)
        frontier = broadcast_if_small(waiting.filter(near).select(F.col("id").alias("src"), "distance"), seen["bytes"])
        offers = edges.join(frontier, "src").groupBy(F.col("dst").alias("id")).agg(F.min(F.col("distance") + F.col("cost")).alias("offer"))
        offers, size = materialize(offers)
        asked = broadcast_if_small(offers.select("id"), size["bytes"])
        before = reduce(DataFrame.unionByName, improvements).join(asked, "id", "left_semi")
        before = before.groupBy("id").agg(F.min("distance").alias("distance"))
        better = F.col("distance").isNull() | (F.col("offer") < F.col("distance"))
        improved = offers.join(before, "id", "left").filter(better).select("id", F.col("offer").alias("distance"))
        rest = waiting.filter(~near).select("id", "distance", F.lit(1).alias("old"))
        both = improved.withColumn("old", F.lit(0)).unionByName(rest)
        best = both.groupBy("id").agg(F.min(F.struct("distance", "old")).alias("best"))
        waiting, seen = materialize(
            best.select("id", "best.distance", (F.col("best.old") == 0).alias("fresh")), nearest=F.min("distance")
        )
        improvements.append(waiting.filter("fresh").select("id", "distance"))
        if len(improvements) == MERGE_TABLES:
            merged, _ = materialize(reduce(DataFrame.unionByName, improvements).groupBy("id").agg(F.min("distance").alias("distance")))
            improvements = [merged]
    return reduce(DataFrame.unionByName, improvements).groupBy("id").agg(F.min("distance").alias("distance"))
