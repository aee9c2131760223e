"""Vertices and edges on long ids, and the sliced adjacency iterative algorithms join with.

Ids are replaced once by 0, 1, 2, ... in id order, so every later shuffle moves
eight-byte keys and "smallest id" stays "smallest number".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from edgeline.functions.expressions import edge_weight
from edgeline.operators.filters import require_edges
from edgeline.operators.statistics import entity_types
from edgeline.runtime import (
    SLICE_ROWS,
    dense_index,
    hot_keys,
    lookup,
    materialize,
    replicate_over_slices,
    slice_rows_of,
)

# Partitions that the edges of a full slice are kept in.
PARTITIONS_PER_SLICE = 80


@dataclass(frozen=True)
class IndexedGraph:
    vertices: DataFrame  # vid, id, entity_type
    edges: DataFrame  # src, dst, weight: distinct directed pairs, no self-loops
    n_vertices: int
    n_edges: int

    def name(self, result: DataFrame) -> DataFrame:
        """Replace `vid` by the entity id."""
        return self.vertices.select("vid", "id").join(result, "vid").drop("vid")


def index_graph(df: DataFrame, weighted: bool = False) -> IndexedGraph:
    """Index a structural edge table. With `weighted`, parallel edges add up their weights."""
    ends = ["subject_id", "subject_type", "object_id", "object_type"]
    df, rows = require_edges(df.select(*ends, *(["confidence"] if weighted else [])))
    weight = edge_weight(F.col("confidence")) if weighted else F.lit(1.0)
    edges = df.select(F.col("subject_id").alias("src"), F.col("object_id").alias("dst"), weight.alias("weight"))
    return index_vertices_edges(entity_types(df), edges, rows, add_up=weighted)


def index_vertices_edges(
    vertices: DataFrame, edges: DataFrame, rows: int | None = None, add_up: bool = False
) -> IndexedGraph:
    """Index a vertex table (id, entity_type) and edges (src, dst, weight) by id.

    Self-loops go and parallel edges become one, with the sum or the largest of their
    weights. Ids are replaced first, so that step already works on numbers. `rows` is
    the number of edges if they are already written.
    """
    vertices, n_vertices = dense_index(vertices.select("id", "entity_type"), "id", "vid")
    ids = vertices.select("id", "vid")
    pairs = edges.filter(F.col("src") != F.col("dst"))
    if rows is None:
        pairs, seen = materialize(pairs)
        rows = seen["rows"]
    named = lookup(pairs, "src", ids.toDF("src", "src_vid"), by=F.col("dst"), rows=rows, how="inner", keys=pairs)
    numbered = lookup(named, "dst", ids.toDF("dst", "dst_vid"), by=F.col("src"), rows=rows, how="inner", keys=pairs)
    combined = (F.sum if add_up else F.max)("weight").alias("weight")
    edges, seen = materialize(
        numbered.groupBy(F.col("src_vid").alias("src"), F.col("dst_vid").alias("dst")).agg(combined)
    )
    return IndexedGraph(vertices, edges, n_vertices, seen["rows"])


class Adjacency:
    """Edges kept partitioned and sorted by `key` so rounds only move vertex state.

    A key with very many edges is spread over slices; `meet` copies that vertex's
    state to each of them. `by` is the column whose hash picks the slice. Keys are counted in
    `keys`, a written table the edges were made from, if one is given.
    """

    def __init__(
        self, edges: DataFrame, n_edges: int, key: str, by: str, slice_rows: int = SLICE_ROWS, *, keys: DataFrame | None = None
    ):
        self.key = key
        self.hot = None
        if n_edges > slice_rows:
            hot, seen = materialize(hot_keys(edges if keys is None else keys, key, slice_rows))
            if seen["rows"]:
                self.hot = hot
                edges = slice_rows_of(edges, hot, key, F.col(by))
        self.on = [key] if self.hot is None else [key, "slice"]
        # A round starts a task per partition, so a small graph gets few: its many rounds are mostly such starts.
        partitions = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = min(partitions, 1 + n_edges * PARTITIONS_PER_SLICE // slice_rows)
        self.edges = (
            edges.repartition(partitions, *self.on)
            .sortWithinPartitions(*self.on)
            .persist(StorageLevel.MEMORY_AND_DISK)
        )

    def meet(self, state: DataFrame) -> DataFrame:
        """Edges joined with the state of their `key` vertex; `state` has a column named `key`."""
        if self.hot is not None:
            state = replicate_over_slices(state, self.hot, self.key)
        joined = self.edges.join(state, self.on)
        return joined if self.hot is None else joined.drop("slice")

    def release(self) -> None:
        self.edges.unpersist()


def both_ways(edges: DataFrame) -> DataFrame:
    """Distinct undirected adjacency (both directions), weights of mutual edges collapsed to the largest."""
    return (
        edges.select(
            F.inline(
                F.array(
                    F.struct(F.col("src"), F.col("dst"), F.col("weight")),
                    F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight")),
                )
            )
        )
        .groupBy("src", "dst")
        .agg(F.max("weight").alias("weight"))
    )
