"""The two result tables: centrality and communities per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.operators.betweenness import PIVOTS, betweenness
from edgeline.operators.communities import louvain
from edgeline.operators.components import connected_components
from edgeline.operators.filters import ANNOTATING_AGENTS, structural_edges
from edgeline.operators.lookups import community_sizes
from edgeline.operators.pagerank import ROUNDS, pagerank
from edgeline.operators.statistics import undirected_degree
from edgeline.operators.vertices import IndexedGraph, index_graph
from edgeline.runtime import lookup
from edgeline.schema import CENTRALITY_SCHEMA, COMMUNITIES_SCHEMA, conform


def assemble_centrality(vertices: DataFrame, ranks: DataFrame, degrees: DataFrame, between: DataFrame) -> DataFrame:
    """One row per vertex; a vertex without a rank or degree gets 0, without betweenness NULL.

    `vertices` (vid, id, entity_type); the others are keyed by vid.
    """
    joined = (
        vertices.join(ranks, "vid", "left").join(degrees, "vid", "left").join(between, "vid", "left")
    )
    return conform(
        joined.select(
            F.col("id").alias("entity_id"),
            "entity_type",
            F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
            F.coalesce("degree", F.lit(0)).alias("degree"),
            "betweenness",
        ),
        CENTRALITY_SCHEMA,
    )


def assemble_communities(vertices: DataFrame, communities: DataFrame, components: DataFrame) -> DataFrame:
    """One row per vertex with community, its size, and component; unknown ones stay NULL."""
    sized = lookup(communities, "community_id", community_sizes(communities), by=F.col("vid"), how="left")
    joined = vertices.join(sized, "vid", "left").join(components, "vid", "left")
    return conform(joined.withColumnRenamed("id", "entity_id"), COMMUNITIES_SCHEMA)


def entity_centrality(
    df: DataFrame,
    threshold: float = 0.0,
    excluded: Sequence[str] = ANNOTATING_AGENTS,
    pagerank_rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    weighted: bool = False,
    graph: IndexedGraph | None = None,
) -> DataFrame:
    if graph is None:
        graph = index_graph(structural_edges(df, threshold, excluded, with_score=weighted), weighted)
    degrees = undirected_degree(graph.edges).withColumnRenamed("id", "vid")
    return assemble_centrality(
        graph.vertices,
        pagerank(graph, rounds=pagerank_rounds),
        degrees,
        betweenness(graph, pivots),
    )


def entity_communities(
    df: DataFrame,
    threshold: float = 0.0,
    excluded: Sequence[str] = ANNOTATING_AGENTS,
    weighted: bool = False,
    graph: IndexedGraph | None = None,
) -> DataFrame:
    if graph is None:
        graph = index_graph(structural_edges(df, threshold, excluded, with_score=weighted), weighted)
    return assemble_communities(graph.vertices, louvain(graph), connected_components(graph))


def components_as_communities(graph: IndexedGraph) -> DataFrame:
    """The communities table with components in the place of communities."""
    components = connected_components(graph)
    return assemble_communities(
        graph.vertices, components.withColumnRenamed("component_id", "community_id"), components
    )
